"""Geography page: KPIs, work mode x salary, hub density, top cities, top-8 share."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions.text import detect_work_mode, work_mode_text
from jobsift.operators.aggs import money_mean, pct
from jobsift.operators.lookups import join_city_population


def with_work_mode(df: DataFrame, patterns: Sequence[tuple[str, str]] = lexicon.WORK_MODE_PATTERNS) -> DataFrame:
    desc = F.col("description") if "description" in df.columns else F.lit(None).cast("string")
    title = F.col("title") if "title" in df.columns else F.lit(None).cast("string")
    return df.withColumn("work_mode", detect_work_mode(work_mode_text(desc, title), patterns))


def city_counts(df: DataFrame, col: str = "city_clean") -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def geo_kpis(df: DataFrame, home_city: str = "Paris",
             patterns: Sequence[tuple[str, str]] = lexicon.WORK_MODE_PATTERNS,
             remote_label: str = "Full Remote", hybrid_label: str = "Hybride") -> DataFrame:
    """Distinct cities, most frequent city (ties by name), % full remote, % hybrid, % in ``home_city``."""
    top_city = (city_counts(df).agg(F.min_by("city_clean", F.struct(-F.col("n"), F.col("city_clean"))))).scalar()
    w = with_work_mode(df, patterns)
    return w.agg(F.count_distinct("city_clean").alias("n_cities"),
                 pct(F.col("work_mode") == remote_label).alias("pct_remote"),
                 pct(F.col("work_mode") == hybrid_label).alias("pct_hybrid"),
                 pct(F.col("city_clean") == home_city).alias("pct_home")).select(
        "n_cities", top_city.alias("top_city"), "pct_remote", "pct_hybrid", "pct_home")


def work_mode_salary(df: DataFrame, patterns: Sequence[tuple[str, str]] = lexicon.WORK_MODE_PATTERNS,
                     measure: str = "salary_avg") -> DataFrame:
    """Rows and mean salary per detected work mode."""
    return (with_work_mode(df, patterns).groupBy("work_mode")
            .agg(F.count(F.lit(1)).alias("n"), money_mean(measure).alias("salary_mean")))


def hub_density(df: DataFrame, population: DataFrame | None = None, top: int = 15) -> DataFrame:
    """The ``top`` cities by rows, with population, and rows per 100k inhabitants."""
    top_cities_ = city_counts(df).orderBy(F.desc("n"), F.asc("city_clean")).limit(top)
    j = join_city_population(top_cities_.withColumnRenamed("city_clean", "city"), population)
    return j.select("city", "n", "population", (F.col("n") / F.col("population") * 100000).alias("per_100k"))


def top_cities(df: DataFrame, n: int = 10, col: str = "city_clean") -> DataFrame:
    """The ``n`` cities with most rows (ties by name)."""
    return city_counts(df, col).orderBy(F.desc("n"), F.asc(col)).limit(n)


def city_share_other(df: DataFrame, top: int = 8, col: str = "city_clean", other: str = "Autres") -> DataFrame:
    """Rows of the ``top`` cities, the rest summed as ``other``.

    The cut-off list is a scalar subquery of at most ``top`` names.
    """
    keep = (city_counts(df, col).orderBy(F.desc("n"), F.asc(col)).limit(top).agg(F.collect_list(col))).scalar()
    label = F.when(F.array_contains(keep, F.col(col)), F.col(col)).otherwise(F.lit(other))
    return df.filter(F.col(col).isNotNull()).groupBy(label.alias(col)).agg(F.count(F.lit(1)).alias("n"))
