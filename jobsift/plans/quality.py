"""Data-quality page: KPIs, completeness, missing values, sources and duplicates, source freshness."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions.text import is_filled
from jobsift.operators.aggs import pct
from jobsift.plans.temporal import source_age


def quality_key(df: DataFrame, title_chars: int | None = None) -> Column:
    """company | title (its first ``title_chars`` characters, if given) | city_clean, each lower/trimmed, null as ''."""
    def part(c):
        return F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))) if c in df.columns else F.lit("")
    title = part("title") if title_chars is None else F.substring(part("title"), 1, title_chars)
    return F.concat_ws("|", part("company"), title, part("city_clean"))


def quality_kpis(df: DataFrame, fields: Sequence[str] = lexicon.QUALITY_FIELDS, title_chars: int | None = None) -> DataFrame:
    """Rows, mean completeness over the present fields, potential duplicates, distinct sources."""
    present = [c for c in fields if c in df.columns]
    rates = [pct(is_filled(c)) for c in present]
    mean_rate = (sum(rates[1:], rates[0]) / len(rates)) if rates else F.lit(0.0)
    n_sources = F.count_distinct("source") if "source" in df.columns else F.lit(1).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), mean_rate.alias("completeness_mean"),
                  (F.count(F.lit(1)) - F.count_distinct(quality_key(df, title_chars))).alias("n_duplicates"),
                  n_sources.alias("n_sources"))


def _status(p: Column) -> Column:
    return F.when(p >= 80, "good").when(p >= 50, "fair").otherwise("poor")


def completeness_by_field(df: DataFrame, fields: Mapping[str, str] = lexicon.COMPLETENESS_FIELDS) -> DataFrame:
    """(field, column, pct_filled, status); 0 for absent columns; status at 80 / 50."""
    specs = list(fields.items())
    wide = df.agg(*[(pct(is_filled(col)) if col in df.columns else F.lit(0.0)).alias(f"f{i}")
                    for i, (_, col) in enumerate(specs)])
    stack = ", ".join(f"'{label}', '{col}', f{i}" for i, (label, col) in enumerate(specs))
    long = wide.selectExpr(f"stack({len(specs)}, {stack}) as (field, column_name, pct_filled)")
    return long.withColumn("status", _status(F.col("pct_filled")))


def missing_by_field(df: DataFrame, fields: Sequence[str] = lexicon.MISSING_FIELDS) -> DataFrame:
    """(column, pct_filled, pct_missing) for the present fields; missing = null."""
    present = [c for c in fields if c in df.columns]
    wide = df.agg(*[pct(F.col(c).isNull()).alias(c) for c in present])
    return (wide.unpivot([], present, "column_name", "pct_missing")
                .select("column_name", (F.lit(100.0) - F.col("pct_missing")).alias("pct_filled"), "pct_missing"))


def source_and_duplicates(df: DataFrame, unknown: str = "Inconnue", title_chars: int | None = None) -> DataFrame:
    """(kind, label, n): rows per source (null as ``unknown``), then unique vs duplicate keys."""
    per_source = (df.groupBy(F.coalesce(F.col("source"), F.lit(unknown)).alias("label"))
                    .agg(F.count(F.lit(1)).alias("n")).select(F.lit("source").alias("kind"), "label", "n"))
    totals = df.agg(F.count(F.lit(1)).alias("total"), F.count_distinct(quality_key(df, title_chars)).alias("uniq"))
    dedup = totals.selectExpr("stack(2, 'Uniques', uniq, 'Doublons potentiels', total - uniq) as (label, n)") \
                  .select(F.lit("dedup").alias("kind"), "label", "n")
    return per_source.unionByName(dedup)


def source_freshness(df: DataFrame, as_of, col: str = "published_at") -> DataFrame:
    """Per source: rows with a date, mean and minimum age in days at ``as_of``."""
    return source_age(df, as_of, col, "source")
