"""Exploration tables: salary statistics per title, contract distribution, city x contract
crosstab, group-median imputation, share of total, top-n per group, skills array."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions.text import extract_skills
from jobsift.operators.aggs import group_quantiles, money_mean, money_std


def salary_describe_by_title(df: DataFrame, col: str = "salary_avg", by: str = "title",
                             preferred_min: int = 5, fallback_min: int = 3) -> DataFrame:
    """count, mean, median, sample std, min, max per title over rows with a salary.

    Minimum group size: ``preferred_min`` if at least ``preferred_min`` groups reach
    it, else ``fallback_min`` (decided by a scalar subquery over the grouped rows).
    """
    rows = df.filter(F.col(col).isNotNull() & F.col(by).isNotNull())
    medians = group_quantiles(rows, [by], col).select(by, F.col("q")[0].alias("median"))
    g = (rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), money_mean(col).alias("mean"),
                              money_std(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max")).join(medians, by))
    n_big = g.agg(F.count_if(F.col("n") >= preferred_min)).scalar()
    threshold = F.when(n_big >= preferred_min, F.lit(preferred_min)).otherwise(F.lit(fallback_min))
    return g.filter(F.col("n") >= threshold)


def share_of_total(grouped: DataFrame, count_col: str = "n", name: str = "pct") -> DataFrame:
    """count / total * 100 on an already grouped (small) frame."""
    total = grouped.agg(F.sum(count_col)).scalar()
    return grouped.withColumn(name, F.col(count_col) * 100 / total)


def contract_distribution(df: DataFrame, col: str = "contract_type") -> DataFrame:
    """Rows per contract (null dropped) and % of all rows (nulls included in the total)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("pct", F.col("n") * 100 / total))


def city_contract_crosstab(df: DataFrame, city: str = "city", contract: str = "contract_type",
                           top: int = 10, all_label: str = "All") -> DataFrame:
    """City x contract counts for the ``top`` cities, with row, column and grand totals
    labelled ``all_label``; long format. Cells are counted first, the CUBE adds counts."""
    keep = (df.filter(F.col(city).isNotNull()).groupBy(city).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.asc(city)).limit(top).agg(F.collect_list(city))).scalar()
    rows = df.filter(F.array_contains(keep, F.col(city)) & F.col(contract).isNotNull())
    cells = rows.groupBy(city, contract).agg(F.count(F.lit(1)).alias("n"))
    cube = cells.cube(city, contract).agg(F.sum("n").alias("n"),
                                         F.grouping(city).alias("_gc"), F.grouping(contract).alias("_gt"))
    return cube.select(F.when(F.col("_gc") == 1, F.lit(all_label)).otherwise(F.col(city)).alias(city),
                       F.when(F.col("_gt") == 1, F.lit(all_label)).otherwise(F.col(contract)).alias(contract), "n")


def city_contract_matrix(df: DataFrame, city: str = "city", contract: str = "contract_type", top: int = 10,
                         contracts: Sequence[str] | None = None) -> DataFrame:
    """The crosstab pivoted: one row per city (and 'All'), one column per contract, zeros filled."""
    long = city_contract_crosstab(df, city, contract, top)
    return long.groupBy(city).pivot(contract, list(contracts) if contracts else None).agg(F.sum("n")).fillna(0)


def impute_group_median(df: DataFrame, col: str = "salary_avg", by: str = "title") -> DataFrame:
    """Null ``col`` filled with the median of its ``by`` group (null when the group key is null).

    Medians are one aggregate per group. Only rows that need one, and have a group,
    are joined with them; the others never move, so null keys meet nowhere.
    """
    med = group_quantiles(df.filter(F.col(by).isNotNull()), [by], col).select(by, F.col("q")[0].alias("_median"))
    needs = F.col(col).isNull() & F.col(by).isNotNull()
    filled = df.where(needs).join(med, by, "left").withColumn(col, F.col("_median")).select(*df.columns)
    return df.where(~needs).unionByName(filled)


def top_n_per_group(df: DataFrame, group: str, order: Sequence, n: int) -> DataFrame:
    """Top ``n`` rows per group, ranked 1..n.

    ``row_number() <= n`` lets Spark plan a partial WindowGroupLimit before the
    shuffle (a map-side top-n), so even a hot group sends at most ``n`` rows per
    map partition to its final task.
    """
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def skills_array(df: DataFrame, text_col: str = "description", skills: Sequence[str] = lexicon.EXPLORE_SKILLS) -> DataFrame:
    """Exploration skills: array of skills found and its size."""
    return df.withColumn("skills", extract_skills(F.col(text_col), skills)).withColumn("n_skills", F.size("skills"))


def top_skills_share(df: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent skills of the ``skills`` array with % of all rows (ties by name)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.select(F.explode("skills").alias("skill")).groupBy("skill").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.asc("skill")).limit(n).withColumn("pct", F.col("n") * 100 / total))
