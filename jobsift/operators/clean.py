"""Cleaning operators: shape raw postings into the 15-column target table.

``build_clean`` chains them: rename -> normalise -> union -> dedup -> enrich ->
type -> project. Everything is a projection except the dedup, which is one
aggregation on the normalised (company, title, city) key with map-side
combining, so a hot key never lands whole in one task.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift import lexicon
from jobsift.functions.contract import infer_contract, normalize_contract
from jobsift.functions.place import normalize_city
from jobsift.functions.salary import parse_salary, salary_avg
from jobsift.functions.text import dedup_key_part, extract_skills_text, norm_key
from jobsift.functions.time import as_of_literal, normalize_date, utc_wallclock

TARGET_TYPES = {
    "title": "string", "company": "string", "city": "string", "contract_type": "string",
    "salary_min": "double", "salary_max": "double", "salary_avg": "double",
    "currency": "string", "description": "string", "category": "string",
    "published_at": "timestamp_ntz", "url": "string", "source": "string",
    "tech_stack": "string", "collected_at": "timestamp_ntz",
}

SOURCE_MAPS = {
    "api": lexicon.API_COLUMN_MAP,
    "third": lexicon.THIRD_SOURCE_COLUMN_MAP,
    "scraped": lexicon.SCRAPED_COLUMN_MAP,
}


def _has_path(df: DataFrame, path: str) -> bool:
    fields = df.schema
    for part in path.split("."):
        if not isinstance(fields, T.StructType) or part not in fields.fieldNames():
            return False
        fields = fields[part].dataType
    return True


def _path_col(path: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct fields become top-level columns named with dotted paths;
    arrays and maps are left as they are."""
    cols: list[Column] = []

    def walk(dtype: T.StructType, prefix: list[str]):
        for f in dtype.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, path)
            else:
                cols.append(F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)))

    walk(df.schema, [])
    return df.select(*cols)


def unwrap_envelope(df: DataFrame, data_col: str = "data", fetched_col: str = "fetched_at") -> DataFrame:
    """Use the record under ``data`` when there is one, else the record itself;
    the envelope's ``fetched_at`` is carried as ``_fetched_at``."""
    has_data = data_col in df.columns and isinstance(df.schema[data_col].dataType, T.StructType)
    if not has_data:
        out = df
        if fetched_col in df.columns:
            out = out.withColumn("_fetched_at", F.col(fetched_col))
        return out
    inner = df.schema[data_col].dataType
    cols = []
    for f in inner.fields:
        inner_col = F.col(f"`{data_col}`.`{f.name}`")
        if f.name in df.columns and f.name != data_col:
            top = F.col(f"`{f.name}`")
            if top_type_matches(df.schema[f.name].dataType, f.dataType):
                cols.append(F.when(F.col(data_col).isNotNull(), inner_col).otherwise(top).alias(f.name))
                continue
        cols.append(inner_col.alias(f.name))
    fetched = F.col(fetched_col) if fetched_col in df.columns else F.lit(None).cast("string")
    return df.select(*cols, fetched.alias("_fetched_at"))


def top_type_matches(a: T.DataType, b: T.DataType) -> bool:
    return a.simpleString() == b.simpleString()


def rename_to_target(df: DataFrame, col_map: Mapping[str, str], source: str) -> DataFrame:
    """Targets from the raw columns present (synonyms coalesced in map order) plus
    a ``source`` literal. ``_fetched_at`` is carried when present."""
    by_target: dict[str, list[str]] = {}
    for raw, target in col_map.items():
        if _has_path(df, raw) or raw in df.columns:
            by_target.setdefault(target, []).append(raw)
    cols = []
    for target, raws in by_target.items():
        exprs = [F.col(f"`{r}`") if r in df.columns else _path_col(r) for r in raws]
        if len(exprs) > 1:
            types = {df.select(e).schema[0].dataType.simpleString() for e in exprs}
            if len(types) > 1:
                exprs = [e.cast("string") for e in exprs]
        cols.append((F.coalesce(*exprs) if len(exprs) > 1 else exprs[0]).alias(target))
    if "_fetched_at" in df.columns:
        cols.append(F.col("_fetched_at"))
    return df.select(*cols, F.lit(source).alias("source"))


def _col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def normalize(df: DataFrame, source: str, as_of=None) -> DataFrame:
    """Normalise one source: rename, dates, salaries, mean, contract, inference, city.

    ``source`` is one of 'api', 'third', 'scraped'. ``as_of`` stands for the
    collection time when the records carry none.
    """
    df = rename_to_target(df, SOURCE_MAPS[source], source)
    g = lambda n, t="string": _col_or_null(df, n, t)
    published = normalize_date(g("published_at"))
    collected = (normalize_date(F.col("_fetched_at")) if "_fetched_at" in df.columns
                 else (as_of_literal(as_of) if as_of is not None else utc_wallclock(F.current_timestamp())))
    if source == "api":
        smin = g("salary_min").cast("string").try_cast("double")
        smax = g("salary_max").cast("string").try_cast("double")
        currency = F.lit("EUR")
    else:
        if "salary_raw" in df.columns:
            parsed = parse_salary(F.col("salary_raw").cast("string"))
            smin, smax, currency = parsed["salary_min"], parsed["salary_max"], parsed["currency"]
        else:
            smin = smax = F.lit(None).cast("double")
            currency = F.lit(None).cast("string")
    contract = normalize_contract(g("contract_type").cast("string"))
    contract = infer_contract(contract, g("title").cast("string"), g("description").cast("string"))
    out = df.select(
        g("title").cast("string").alias("title"),
        g("company").cast("string").alias("company"),
        normalize_city(g("city").cast("string")).alias("city"),
        contract.alias("contract_type"),
        smin.alias("salary_min"),
        smax.alias("salary_max"),
        salary_avg(smin, smax).alias("salary_avg"),
        currency.alias("currency"),
        g("description").cast("string").alias("description"),
        g("category").cast("string").alias("category"),
        published.alias("published_at"),
        g("url").cast("string").alias("url"),
        F.col("source"),
        collected.alias("collected_at"),
        g("contract_time").cast("string").alias("contract_time"),
        g("source_id").cast("string").alias("source_id"),
        g("remote").cast("string").alias("remote"),
    )
    return out


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Outer union by column name (missing columns are null)."""
    frames = list(frames)
    if not frames:
        raise ValueError("no source to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def stringify_complex(df: DataFrame) -> DataFrame:
    """Array, struct and map columns as JSON text, so rows can be compared."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            cols.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def _null_count(cols: Sequence[str]) -> Column:
    return sum((F.col(f"`{c}`").isNull().cast("int") for c in cols), F.lit(0))


def keep_most_complete(df: DataFrame, key: Sequence[Column], count_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the fewest nulls over ``count_cols`` (default:
    all columns); ties broken by the column values in column order (nulls first).

    Implemented as ``min(struct(nulls, *columns))`` per key: a plain aggregation
    that Spark combines map-side, so exact duplicates and hot keys are reduced
    before the shuffle and no group is ever materialised in one task.
    """
    df = stringify_complex_maps(df)
    cols = df.columns
    count_cols = list(count_cols) if count_cols is not None else cols
    best = F.min(F.struct(_null_count(count_cols).alias("_nulls"),
                          *[F.col(f"`{c}`") for c in cols])).alias("_best")
    keyed = [k.alias(f"_k{i}") for i, k in enumerate(key)]
    return df.groupBy(*keyed).agg(best).select(*[F.col(f"_best.`{c}`").alias(c) for c in cols])


def stringify_complex_maps(df: DataFrame) -> DataFrame:
    """Only map columns as JSON (maps cannot be compared or grouped)."""
    if not any(isinstance(f.dataType, T.MapType) for f in df.schema.fields):
        return df
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.MapType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def dedup_keep_most_complete(df: DataFrame, keys: Sequence[str] = ("company", "title", "city"),
                             count_cols: Sequence[str] | None = None) -> DataFrame:
    """Cleaning dedup: exact duplicates and same lower/trimmed (company, title, city)
    collapse to the most complete row. Null key parts compare as the text 'nan'."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df.dropDuplicates()
    return keep_most_complete(df, [dedup_key_part(k) for k in present], count_cols)


def dedup_ignoring(df: DataFrame, ignore: Sequence[str] = ("collected_at",),
                   keys: Sequence[str] = ("title", "company", "city")) -> DataFrame:
    """Exploration dedup: duplicates ignoring ``ignore`` columns, then one row per
    normalised key (null key part = ''), the most complete kept."""
    present = [k for k in keys if k in df.columns]
    kept = [c for c in df.columns if c not in ignore]
    key = [norm_key(k) for k in present] if present else [F.col(f"`{c}`") for c in kept]
    return keep_most_complete(df, key)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicate rows removed."""
    return stringify_complex_maps(df).dropDuplicates()


def enrich(df: DataFrame, skills: Sequence[str] = lexicon.TECH_SKILLS, text_col: str = "description") -> DataFrame:
    """Add ``tech_stack``: skills found in the description, ', '-joined ('' if none)."""
    if text_col not in df.columns:
        return df.withColumn("tech_stack", F.lit(""))
    return df.withColumn("tech_stack", extract_skills_text(F.col(text_col), skills))


def cast_types(df: DataFrame, types: Mapping[str, str] = TARGET_TYPES) -> DataFrame:
    """Strings as strings, numbers with try_cast (bad -> null), timestamps parsed (bad -> null)."""
    out = []
    for c in df.columns:
        t = types.get(c)
        col = F.col(f"`{c}`")
        if t == "double":
            out.append(col.cast("string").try_cast("double").alias(c) if dict(df.dtypes)[c] == "string"
                       else col.cast("double").alias(c))
        elif t == "timestamp_ntz":
            dt = dict(df.dtypes)[c]
            conv = col if dt == "timestamp_ntz" else (utc_wallclock(col) if dt == "timestamp" else normalize_date(col))
            out.append(conv.alias(c))
        elif t == "string":
            out.append(col.cast("string").alias(c))
        else:
            out.append(col)
    return df.select(*out)


def empty_postings(spark) -> DataFrame:
    """An empty frame with the target schema (what reports get when nothing is loaded)."""
    from pyspark.sql import types as _T
    fields = [_T.StructField(c, {"string": _T.StringType(), "double": _T.DoubleType(),
                                 "timestamp_ntz": _T.TimestampNTZType()}[TARGET_TYPES[c]]) for c in lexicon.TARGET_COLUMNS]
    return spark.createDataFrame([], _T.StructType(fields))


def project_target(df: DataFrame, columns: Sequence[str] = lexicon.TARGET_COLUMNS) -> DataFrame:
    """The target columns in order; absent ones as typed nulls."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(TARGET_TYPES.get(c, "string")).alias(c)
                       for c in columns])


def build_clean(frames: Mapping[str, DataFrame], as_of=None, skills: Sequence[str] = lexicon.TECH_SKILLS,
                on_step=lambda name, df: df) -> DataFrame:
    """The whole cleaning job over raw frames keyed by source kind.

    ``on_step(name, df)`` may wrap the frame after the union and after the dedup, e.g. to observe row counts.
    """
    normalised = [normalize(df, kind, as_of) for kind, df in frames.items()]
    unioned = on_step("union", union_sources(normalised))
    deduped = on_step("dedup", dedup_keep_most_complete(unioned))
    enriched = enrich(deduped, skills)
    return project_target(cast_types(enriched))
