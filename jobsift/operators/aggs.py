"""Aggregate expressions whose value does not depend on partitioning.

Double sums depend on the order rows are added, so on a cluster two runs can
differ in the last bits. Money is therefore summed as whole cents (decimal, so
it cannot overflow) and divided once; shares are integer counts divided once;
medians and quartiles are ranks among counted cents. Results are then bit-identical
across partitionings and with any SQL engine that does the same.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsift.functions.salary import to_cents


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def money_mean(col: Column | str) -> Column:
    """Mean of a money column at cent precision (null-skipping)."""
    cents = to_cents(col).cast("decimal(38,0)")
    return F.try_divide(F.sum(cents).cast("double"), F.count(_c(col)) * 100)


#: Cents of a first-level bucket of ``value_counts`` ranks.
BUCKET_CENTS = 4096


def value_counts(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """(by.., _cents, _c): rows per group and amount, in whole cents; null amounts are left out. Combined before the shuffle."""
    return df.where(F.col(col).isNotNull()).groupBy(*by, to_cents(col).alias("_cents")).agg(F.count(F.lit(1)).alias("_c"))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right`` with its keys renamed, and the null-safe join condition."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return renamed, on


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group keys, null being a group of its own."""
    renamed, on = _same(left, right, keys)
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def count_quantiles(counts: DataFrame, by: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """(by.., n, q): exact, linearly interpolated quantiles (array<double>) from ``value_counts`` rows.

    Counts are summed by buckets of amounts first; running sums over a group's
    buckets tell which buckets hold the wanted ranks, and only those buckets'
    amounts are ranked. So neither a group's rows nor all its different amounts
    meet in one task, and no buffer grows with a group.
    """
    by = list(by)
    part = by or [F.lit(1)]
    bucketed = counts.withColumn("_b", F.floor(F.col("_cents") / BUCKET_CENTS))
    sums = bucketed.groupBy(*by, "_b").agg(F.sum("_c").alias("_n"))
    running = Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*by, "_b", "_n", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"),
                       F.sum("_n").over(Window.partitionBy(*part)).alias("n"))
    at = F.array(*[F.lit(float(q)) * (F.col("n") - 1) for q in qs])
    ranks = F.array_distinct(F.flatten(F.transform(at, lambda x: F.array(F.floor(x), F.ceil(x)))))
    held = F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")))
    wanted = sums.select(*by, "_b", "_before", "n", held.alias("_ranks")).where(F.size("_ranks") > 0)
    inside = join_groups(bucketed, wanted, [*by, "_b"])
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*by, "_b").orderBy("_cents").rowsBetween(Window.unboundedPreceding, 0))
    hit = (inside.withColumn("_upto", upto)
           .select(*by, "n", "_cents", F.explode(F.filter("_ranks", lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_c")))).alias("_rank")))
    found = hit.groupBy(*by, "n").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_cents"))).alias("_m"))

    def quantile(q: float) -> Column:
        x = F.lit(float(q)) * (F.col("n") - 1)
        low, high = F.floor(x), F.ceil(x)
        return (F.when(low == high, F.col("_m")[low].cast("double"))
                .otherwise((high - x) * F.col("_m")[low] + (x - low) * F.col("_m")[high])) / 100

    return found.select(*by, "n", F.array(*[quantile(q) for q in qs]).alias("q"))


def group_quantiles(df: DataFrame, by: Sequence[str], col: str, qs: Sequence[float] = (0.5,)) -> DataFrame:
    """(by.., n, q): exact quantiles of a money column per group, at cent precision."""
    return count_quantiles(value_counts(df, by, col), by, qs)


def median_scalar(df: DataFrame, col: str) -> Column:
    """Exact median of a money column as a scalar subquery; null without values."""
    return group_quantiles(df, [], col).select(F.col("q")[0]).scalar()


def distinct_scalar(df: DataFrame, col: str) -> Column:
    """Number of different values (nulls left out) as a scalar subquery."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().agg(F.count(F.lit(1))).scalar()


def money_std(col: Column | str) -> Column:
    """Sample standard deviation, rounded to cents."""
    return F.round(F.stddev_samp(_c(col)), 2)


def pct(cond: Column) -> Column:
    """Share of rows (in %) for which ``cond`` is true (nulls count as false)."""
    return F.try_divide(F.count_if(F.coalesce(cond, F.lit(False))) * 100, F.count(F.lit(1)))


def pct_of(cond: Column, total: Column) -> Column:
    return F.try_divide(F.count_if(F.coalesce(cond, F.lit(False))) * 100, total)


def mean_days(micros: Column | str) -> Column:
    """Mean of a duration given in whole microseconds, in fractional days."""
    return F.try_divide(F.sum(_c(micros).cast("decimal(38,0)")).cast("double"),
                        F.count(_c(micros)) * 86_400_000_000)
