"""Data-governance rules: retention window and takedown requests, as filters on a
frame and as commits to a versioned table (``sinks.versioned``)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.functions.time import as_of_literal
from jobsift.sinks.versioned import VersionedTable


def retention_filter(df: DataFrame, days: int, as_of, col: str = "collected_at") -> DataFrame:
    """Rows collected within the last ``days`` days before ``as_of`` (inclusive)."""
    cutoff = as_of_literal(as_of) - F.make_interval(days=F.lit(days))
    return df.filter(F.col(col).cast("timestamp_ntz") >= cutoff)


def takedown(df: DataFrame, requests: DataFrame, keys: Sequence[str] = ("company",)) -> DataFrame:
    """Remove every row matching a request (anti-join on ``keys``)."""
    return df.join(requests.select(*keys).dropDuplicates(), list(keys), "left_anti")


def retention_purge(store: VersionedTable, days: int, as_of: str) -> int:
    """Commit ``store`` without what was collected more than ``days`` days before ``as_of``. Returns the version."""
    cutoff = store.spark.range(1).select((as_of_literal(as_of) - F.make_interval(days=F.lit(days))).cast("string")).head()[0]
    return store.purge(cutoff)


def takedown_commit(store: VersionedTable, requests: DataFrame, keys: Sequence[str] = ("company",)) -> int:
    """Commit ``store`` without the rows that match a request. Returns the version."""
    return store.remove(requests, list(keys))
