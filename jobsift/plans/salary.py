"""Salary page: KPIs, skill premium, by source, by city, box statistics."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions.contract import contract_label_substr
from jobsift.functions.text import split_skills, text_blob, title_case
from jobsift.operators.aggs import count_quantiles, group_quantiles, join_groups, median_scalar, money_mean, value_counts
from jobsift.plans.overview import skill_counts


def _salaried(df: DataFrame) -> DataFrame:
    return df.filter(F.col("salary_avg").isNotNull())


def salary_kpis(df: DataFrame) -> DataFrame:
    """Over rows with a salary: mean, min(salary_min), max(salary_max), median; and % of rows with one."""
    has = F.col("salary_avg").isNotNull()
    median = median_scalar(df, "salary_avg")
    return df.agg(money_mean("salary_avg").alias("salary_mean"),
                  F.min(F.when(has, F.col("salary_min"))).alias("salary_min"),
                  F.max(F.when(has, F.col("salary_max"))).alias("salary_max"),
                  F.try_divide(F.count("salary_avg") * 100, F.count(F.lit(1))).alias("pct_with_salary")).withColumn("salary_median", median)


def _premium(per_skill: DataFrame, global_mean) -> DataFrame:
    return per_skill.withColumn("premium", (F.col("salary_mean") - global_mean) / global_mean * 100)


def skill_premium(df: DataFrame, top: int = 20, min_rows: int = 2, show: int = 15,
                  fallback: Sequence[str] = lexicon.PREMIUM_FALLBACK_SKILLS, allow_fallback: bool = True) -> DataFrame:
    """Mean salary of the rows listing each of the ``top`` most listed skills
    (lower-cased, counted over all rows), for skills with >= ``min_rows`` salaried
    rows, and its premium (%) over the global mean; the ``show`` highest premiums.

    When no skill qualifies, the ``fallback`` skills are searched in the text blob
    with a minimum of one row: both branches are one plan, and a scalar decides.
    Returns nothing when fewer than 3 rows have a salary.
    """
    sal = _salaried(df)
    whole = sal.agg(F.struct(money_mean("salary_avg").alias("mean"), F.count(F.lit(1)).alias("n"))).scalar()
    top_list = (skill_counts(df, lower=True).orderBy(F.desc("n"), F.asc("skill")).limit(top)
                .agg(F.collect_list("skill"))).scalar()
    per_row = sal.select("salary_avg", F.explode(F.array_intersect(F.array_distinct(split_skills("tech_stack", lower=True)),
                                                                    top_list)).alias("skill"))
    listed = (per_row.groupBy("skill").agg(F.count(F.lit(1)).alias("n"), money_mean("salary_avg").alias("salary_mean"))
                     .filter(F.col("n") >= min_rows)
                     .select(title_case("skill").alias("skill"), "n", "salary_mean"))
    rows = listed
    if allow_fallback:
        blob = text_blob(F.col("description") if "description" in df.columns else F.lit(None),
                         F.col("tech_stack") if "tech_stack" in df.columns else F.lit(None))
        none_listed = listed.agg(F.count(F.lit(1)) == 0).scalar()
        hits = sal.where(none_listed).select("salary_avg", F.explode(F.filter(F.array(*[F.lit(s) for s in fallback]),
                                                                               lambda s: blob.contains(F.lower(s)))).alias("skill"))
        rows = listed.unionByName(hits.groupBy("skill").agg(F.count(F.lit(1)).alias("n"), money_mean("salary_avg").alias("salary_mean")))
    return (_premium(rows, whole["mean"]).filter(whole["n"] >= 3)
            .orderBy(F.desc("premium"), F.asc("skill")).limit(show))


def salary_by_source(df: DataFrame) -> DataFrame:
    """Per source (rows with salary): mean, median, rows."""
    sal = _salaried(df)
    means = sal.groupBy("source").agg(money_mean("salary_avg").alias("salary_mean"))
    medians = group_quantiles(sal, ["source"], "salary_avg").select("source", F.col("q")[0].alias("salary_median"), "n")
    return join_groups(means, medians, ["source"])


def salary_by_city(df: DataFrame, min_rows: int = 3, top: int = 10) -> DataFrame:
    """Mean salary per city with at least ``min_rows`` salaried rows; the ``top`` highest."""
    g = _salaried(df).groupBy("city_clean").agg(money_mean("salary_avg").alias("salary_mean"),
                                                 F.count(F.lit(1)).alias("n"))
    return g.filter(F.col("n") >= min_rows).orderBy(F.desc("salary_mean"), F.asc("city_clean")).limit(top)


def box_stats(df: DataFrame, by: str, col: str = "salary_avg") -> DataFrame:
    """Per group: rows, min, q1, median, q3, max, the 1.5 x IQR fences (linear
    interpolation) and the whisker ends (most extreme values inside the fences).

    Everything comes from the counts per group and amount: the rows are read once.
    """
    counts = value_counts(df, [by], col)
    g = count_quantiles(counts, [by], (0.0, 0.25, 0.5, 0.75, 1.0))
    q1, q3 = F.col("q")[1], F.col("q")[3]
    stats = g.select(by, "n", F.col("q")[0].alias("min"), q1.alias("q1"), F.col("q")[2].alias("median"),
                     q3.alias("q3"), F.col("q")[4].alias("max"),
                     (q1 - (q3 - q1) * 1.5).alias("lower_fence"), (q3 + (q3 - q1) * 1.5).alias("upper_fence"))
    amounts = counts.select(by, (F.col("_cents") / 100).alias("_v"))
    inside = (join_groups(amounts, stats.select(by, "lower_fence", "upper_fence"), [by])
              .filter(F.col("_v").between(F.col("lower_fence"), F.col("upper_fence")))
              .groupBy(by).agg(F.min("_v").alias("whisker_low"), F.max("_v").alias("whisker_high")))
    return join_groups(stats, inside, [by], "left")


def salary_box(df: DataFrame) -> DataFrame:
    """Box statistics per contract label (substring rules)."""
    return box_stats(df.withColumn("contract_label", contract_label_substr("contract_type")), "contract_label")


def salary_box_by_title(df: DataFrame, top: int = 12, min_rows: int = 3) -> DataFrame:
    """Exploration variant: the ``top`` most frequent titles with >= ``min_rows`` salaried rows."""
    sal = _salaried(df)
    titles = (sal.filter(F.col("title").isNotNull()).groupBy("title").agg(F.count(F.lit(1)).alias("cnt"))
                 .filter(F.col("cnt") >= min_rows).orderBy(F.desc("cnt"), F.asc("title")).limit(top).select("title"))
    return box_stats(sal.join(F.broadcast(titles), "title", "left_semi"), "title")
