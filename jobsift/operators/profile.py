"""Column profiling and shaping: null profile, sparse-column drop, fills, truncation."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions.text import truncate_text


def missing_profile(df: DataFrame, nonzero_only: bool = True) -> DataFrame:
    """(column_name, missing_pct) for every column, one aggregation pass."""
    cols = df.columns
    wide = df.agg(*[(F.count_if(F.col(f"`{c}`").isNull()) * 100 / F.count(F.lit(1))).alias(c) for c in cols])
    long = wide.unpivot([], [F.col(f"`{c}`") for c in cols], "column_name", "missing_pct")
    if nonzero_only:
        long = long.filter(F.col("missing_pct") > 0)
    return long


def sparse_columns(df: DataFrame, threshold: float = lexicon.SPARSE_COLUMN_THRESHOLD) -> list[str]:
    """Columns whose null share exceeds ``threshold`` (one small action: a one-row profile)."""
    row = df.agg(*[(F.count_if(F.col(f"`{c}`").isNull()) / F.count(F.lit(1))).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] is not None and row[c] > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = lexicon.SPARSE_COLUMN_THRESHOLD) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    present = {k: v for k, v in values.items() if k in df.columns}
    return df.fillna(present) if present else df


def truncate_for_export(df: DataFrame, text_cols=("description",), n: int | None = None,
                        date_cols=("published_at", "collected_at")) -> DataFrame:
    """Dates as text and, if ``n`` is given, texts cut to ``n`` characters, for an export table."""
    out = df
    for c in text_cols:
        if c in out.columns and n is not None:
            out = out.withColumn(c, truncate_text(c, n))
    for c in date_cols:
        if c in out.columns:
            out = out.withColumn(c, F.col(c).cast("string"))
    return out


def explore_rename(df: DataFrame, mapping: Mapping[str, str], source: str | None = None) -> DataFrame:
    """Exploration shaping: the mapped columns present (dotted paths allowed), renamed,
    in map order; ``source`` fills the '_source' entry when given."""
    from jobsift.operators.clean import _has_path, _path_col
    cols = []
    for raw, name in mapping.items():
        if raw == "_source" and source is not None:
            cols.append(F.lit(source).alias(name))
        elif raw in df.columns:
            cols.append(F.col(f"`{raw}`").alias(name))
        elif "." in raw and _has_path(df, raw):
            cols.append(_path_col(raw).alias(name))
    return df.select(*cols)


def exploration_job(raw: DataFrame, source: str, mapping: Mapping[str, str] = lexicon.EXPLORE_API_RENAME,
                    threshold: float = lexicon.SPARSE_COLUMN_THRESHOLD, n: int | None = None) -> DataFrame:
    """The exploration end to end, one plan: renamed columns, sparse ones dropped, mean salary (outliers nulled),
    exact duplicates dropped, missing salaries imputed by title, one row per normalised posting, export table."""
    from jobsift.functions.salary import salary_avg_explore
    from jobsift.operators.clean import dedup_ignoring, distinct_rows
    from jobsift.plans.explore import impute_group_median
    df = drop_sparse_columns(explore_rename(raw, mapping, source), threshold)
    if {"salaire_min", "salaire_max"} <= set(df.columns):
        df = df.withColumn("salaire_moyen", salary_avg_explore("salaire_min", "salaire_max")).drop("salaire_min", "salaire_max")
    df = distinct_rows(df)
    if {"salaire_moyen", "intitule_poste"} <= set(df.columns):
        df = impute_group_median(df, "salaire_moyen", "intitule_poste")
    return explore_export(dedup_ignoring(df, ignore=(), keys=("intitule_poste", "entreprise", "ville")), n=n)


def explore_export(df: DataFrame, columns=lexicon.EXPLORE_EXPORT_COLUMNS, n: int | None = None) -> DataFrame:
    """Export table of the exploration: the listed columns present, dates as text,
    descriptions whole unless ``n`` is given."""
    out = df.select(*[c for c in columns if c in df.columns])
    return truncate_for_export(out, text_cols=("description",), n=n, date_cols=("date_publication",))
