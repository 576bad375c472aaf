"""Connected components of a graph held in a DataFrame, by alternating star contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import stored


def _nearest(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours, over directed rows (u, v)."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of u moves to u's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.where("v > u").join(_nearest(both), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours move to the smallest of these. Rows have v < u."""
    least = _nearest(edges)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that occurs in ``edges`` (u, v), root the smallest node reachable.

    Two steps alternate until the edges stay as they are, then every edge points
    at its root. Each round is written to the shared folder, so lineage stays
    short. A hub's rows meet only a pre-aggregated minimum, in joins that AQE
    splits. Loops and repeated edges are ignored; no edges give no rows.
    """
    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).head())

    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = state(now)
    while before[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        after = state(now)
        if after == before:
            break
        before = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
