"""Time page: KPIs, weekday and hour profiles, months, freshness, daily series.

Daily series windows (moving average, running total) run on the daily
aggregate, whose size is the number of calendar days, not the number of rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions.time import (age_bucket, age_micros, as_of_literal, publication_date, publication_hour,
                                    publication_month, publication_weekday, weekday_label_fr)
from jobsift.operators.aggs import mean_days
from jobsift.operators.lookups import calendar_dim, labels_dim, zero_fill


def _dated(df: DataFrame, col: str = "published_at") -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def daily_counts(df: DataFrame, col: str = "published_at") -> DataFrame:
    return _dated(df, col).groupBy(publication_date(col).alias("date")).agg(F.count(F.lit(1)).alias("n"))


def time_kpis(df: DataFrame, as_of, col: str = "published_at", recent_days: int = 7) -> DataFrame:
    """Distinct days, rows per day, peak day (ties: earliest), rows in the last ``recent_days``."""
    recent = F.col(col).cast("timestamp_ntz") >= as_of_literal(as_of) - F.make_interval(days=F.lit(recent_days))
    daily = (_dated(df, col).groupBy(publication_date(col).alias("date"))
             .agg(F.count(F.lit(1)).alias("n"), F.count_if(recent).alias("recent")))
    return daily.agg(F.count(F.lit(1)).alias("n_days"),
                     (F.sum("n") / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("per_day"),
                     F.min_by("date", F.struct(-F.col("n"), F.col("date"))).alias("peak_day"),
                     F.coalesce(F.sum("recent"), F.lit(0)).alias("n_recent"))


def by_weekday(df: DataFrame, col: str = "published_at") -> DataFrame:
    """Rows per weekday (Monday = 0), zero-filled, with the French label."""
    counts = _dated(df, col).groupBy(publication_weekday(col).alias("weekday")).agg(F.count(F.lit(1)).alias("n"))
    filled = zero_fill(counts, calendar_dim(df.sparkSession, "weekday", 7), "weekday", "n")
    return filled.select("weekday", weekday_label_fr("weekday").alias("label"), "n")


def by_hour(df: DataFrame, col: str = "published_at") -> DataFrame:
    """Rows per hour of day 0..23, zero-filled."""
    counts = _dated(df, col).groupBy(publication_hour(col).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return zero_fill(counts, calendar_dim(df.sparkSession, "hour", 24), "hour", "n")


def by_month(df: DataFrame, col: str = "published_at") -> DataFrame:
    """Rows per year-month 'yyyy-MM'."""
    return _dated(df, col).groupBy(publication_month(col).alias("month")).agg(F.count(F.lit(1)).alias("n"))


def freshness_buckets(df: DataFrame, as_of, col: str = "published_at") -> DataFrame:
    """Rows per age bucket (right-closed day bins), zero-filled in bucket order."""
    days = age_micros(col, as_of) / F.lit(86_400_000_000)
    counts = (_dated(df, col).select(age_bucket(days).alias("bucket")).filter(F.col("bucket").isNotNull())
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    dim = labels_dim(df.sparkSession, "bucket", lexicon.AGE_BUCKET_LABELS)
    return zero_fill(counts, dim, "bucket", "n").select(F.col("_order").alias("position"), "bucket", "n")


def moving_average_3(df: DataFrame, col: str = "published_at") -> DataFrame:
    """Daily counts with the trailing 3-day (3-row) mean over days that have rows."""
    w = Window.orderBy("date").rowsBetween(-2, 0)
    return daily_counts(df, col).withColumn("ma3", F.avg("n").over(w))


def cumulative_count(df: DataFrame, col: str = "published_at") -> DataFrame:
    """Daily counts with their running total."""
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return daily_counts(df, col).withColumn("cumulative", F.sum("n").over(w))


def source_age(df: DataFrame, as_of, col: str = "published_at", by: str = "source") -> DataFrame:
    """Per source (rows with a date): rows, mean and minimum age in days."""
    a = age_micros(col, as_of)
    return (_dated(df, col).select(by, a.alias("_age"))
            .groupBy(by).agg(F.count(F.lit(1)).alias("n"), mean_days("_age").alias("mean_age_days"),
                             (F.min("_age") / F.lit(86_400_000_000)).alias("min_age_days")))
