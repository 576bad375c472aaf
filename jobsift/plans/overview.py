"""Overview page: KPIs, histogram, contract share, map, top skills, detail table."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions.contract import contract_label_exact
from jobsift.functions.salary import to_cents
from jobsift.functions.text import split_skills
from jobsift.operators.aggs import distinct_scalar, median_scalar, money_mean, pct


def overview_kpis(df: DataFrame) -> DataFrame:
    """One row: rows, salary mean/median/min/max, CDI/Stage/Alternance counts and
    shares, distinct companies and cities, rows with a skill list. The median and
    the distinct counts are aggregations of their own column, so no row is copied
    and none of them meets in one task."""
    ct = F.col("contract_type")
    alone = {"salary_median": median_scalar(df, "salary_avg"), "n_companies": distinct_scalar(df, "company"),
             "n_cities": distinct_scalar(df, "city_clean")}
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            money_mean("salary_avg").alias("salary_mean"),
            F.min("salary_min").alias("salary_min"),
            F.max("salary_max").alias("salary_max")]
    for label, name in (("CDI", "cdi"), ("Stage", "stage"), ("Alternance", "alternance")):
        aggs += [F.count_if(ct == label).alias(f"n_{name}"), pct(ct == label).alias(f"pct_{name}")]
    aggs += [F.count_if(F.coalesce(F.col("tech_stack"), F.lit("")) != "").alias("n_with_skills")]
    return df.agg(*aggs).withColumns(alone)


def header_stats(df: DataFrame) -> DataFrame:
    """Unfiltered header: rows, companies, cities, mean salary. Distinct counts are aggregations of their own column."""
    whole = df.agg(F.count(F.lit(1)).alias("n_rows"), money_mean("salary_avg").alias("salary_mean"))
    return whole.select("n_rows", distinct_scalar(df, "company").alias("n_companies"), distinct_scalar(df, "city_clean").alias("n_cities"), "salary_mean")


def salary_histogram(df: DataFrame, bins: int = 25, col: str = "salary_avg") -> DataFrame:
    """Equal-width bins between the min and max salary (last bin closed).

    Bounds come from a scalar subquery (one small aggregate, no join); bins are
    computed on cents, so edges are exact.
    """
    cents = df.filter(F.col(col).isNotNull()).select(to_cents(col).alias("c"))
    bounds = cents.agg(F.struct(F.min("c").alias("lo"), F.max("c").alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((F.col("c") - lo) * bins / (hi - lo)) + 1, F.lit(bins)))
    return (cents.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin",
                    ((lo * bins + (F.col("bin") - 1) * (hi - lo)) / (bins * 100)).alias("bin_start"),
                    ((lo * bins + F.col("bin") * (hi - lo)) / (bins * 100)).alias("bin_end"),
                    "n"))


def contract_share(df: DataFrame, min_share: float = lexicon.CONTRACT_SHARE_MIN) -> DataFrame:
    """Rows per contract label; labels under ``min_share`` of all rows merged into 'Autre'."""
    counts = df.groupBy(contract_label_exact("contract_type").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # runs on <= a dozen label rows
    small = F.col("n") < total * min_share
    return (counts.withColumn("label", F.when(small, F.lit(lexicon.CONTRACT_OTHER)).otherwise(F.col("label")))
            .groupBy("label").agg(F.sum("n").alias("n")))


def city_map(df: DataFrame) -> DataFrame:
    """Per city with coordinates: lat, lon, rows, mean salary."""
    geo = df.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return geo.groupBy("city_clean").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"),
                                         F.count(F.lit(1)).alias("n"), money_mean("salary_avg").alias("salary_mean"))


def skill_counts(df: DataFrame, lower: bool = False, col: str = "tech_stack") -> DataFrame:
    """Mentions per skill over the ', '-joined lists (partial aggregation before the shuffle)."""
    return (df.select(F.explode(split_skills(col, lower)).alias("skill"))
              .groupBy("skill").agg(F.count(F.lit(1)).alias("n")))


def top_skills(df: DataFrame, n: int = 15, col: str = "tech_stack") -> DataFrame:
    """The ``n`` most mentioned skills (ties by name)."""
    return skill_counts(df, col=col).orderBy(F.desc("n"), F.asc("skill")).limit(n)


DETAIL_COLUMNS = ["title", "company", "city_clean", "contract_type", "salary_avg", "tech_stack"]


def detail_table(df: DataFrame, order_by: list[str] | None = None, page: int | None = None,
                 page_size: int = 12, where: str | None = None) -> DataFrame:
    """The six display columns; optional filter, sort and page (``page`` from 0)."""
    out = df.select(*[c for c in DETAIL_COLUMNS if c in df.columns])
    if where:
        out = out.filter(where)
    if order_by:
        out = out.orderBy(*order_by)
    if page is not None:
        out = out.offset(page * page_size).limit(page_size)
    return out
