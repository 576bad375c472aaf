"""Lookups against small dimensions, stated as joins.

Dimensions built here from the fixed lexicon have a known, constant size
(28 cities, 7 weekdays, 24 hours, 6 buckets), so broadcasting them is safe.
Dimensions passed in by the caller are joined without a hint: Spark broadcasts
them only if its size estimate is under ``autoBroadcastJoinThreshold``.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsift import lexicon
from jobsift.functions.place import city_clean


def coords_dim(spark: SparkSession, coords: Mapping[str, tuple[float, float]] = lexicon.CITY_COORDS) -> DataFrame:
    rows = [(c, float(la), float(lo)) for c, (la, lo) in coords.items()]
    return spark.createDataFrame(rows, "city_clean string, lat double, lon double")


def population_dim(spark: SparkSession, population: Mapping[str, int] = lexicon.CITY_POPULATION) -> DataFrame:
    return spark.createDataFrame(list(population.items()), "city string, population bigint")


def _join_dim(df: DataFrame, dim: DataFrame, on: str, how: str, literal: bool) -> DataFrame:
    return df.join(F.broadcast(dim) if literal else dim, on, how)


def with_dashboard_columns(df: DataFrame, coords: DataFrame | None = None) -> DataFrame:
    """Served table + ``city_clean`` + (lat, lon) by a left lookup (null if unknown)."""
    spark = df.sparkSession
    literal = coords is None
    dim = coords if coords is not None else coords_dim(spark)
    dim = dim.select("city_clean", "lat", "lon")
    return _join_dim(df.withColumn("city_clean", city_clean("city")), dim, "city_clean", "left", literal)


def join_city_coords(df: DataFrame, coords: DataFrame | None = None, key: str = "city_clean") -> DataFrame:
    """Left lookup key -> (lat, lon)."""
    literal = coords is None
    dim = (coords if coords is not None else coords_dim(df.sparkSession)).withColumnRenamed("city_clean", key)
    return _join_dim(df, dim.select(key, "lat", "lon"), key, "left", literal)


def join_city_population(df: DataFrame, population: DataFrame | None = None, key: str = "city") -> DataFrame:
    """Inner lookup key -> population (unknown cities dropped)."""
    literal = population is None
    dim = (population if population is not None else population_dim(df.sparkSession)).withColumnRenamed("city", key)
    return _join_dim(df, dim.select(key, "population"), key, "inner", literal)


def calendar_dim(spark: SparkSession, name: str, n: int) -> DataFrame:
    """0..n-1 as a one-column frame (n is a small constant)."""
    return spark.range(n).select(F.col("id").cast("int").alias(name))


def labels_dim(spark: SparkSession, name: str, labels: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(i, lab) for i, lab in enumerate(labels)], f"_order int, {name} string")


def zero_fill(counts: DataFrame, dim: DataFrame, key: str, count_col: str = "count") -> DataFrame:
    """Every key of ``dim`` with its count, 0 where absent.

    ``counts`` is grouped by a key of ``dim``'s small constant domain, so it has at
    most as many rows as ``dim``: it is the broadcast (build) side of the left join.
    """
    return (dim.join(F.broadcast(counts), key, "left")
            .withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0)).cast("bigint")))


def with_global_scalar(df: DataFrame, one_value: DataFrame, name: str) -> DataFrame:
    """Attach a one-row, one-column aggregate to every row as a scalar subquery."""
    return df.withColumn(name, one_value.scalar())
