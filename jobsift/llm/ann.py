"""Approximate nearest neighbours with a forest of random-projection trees.

Each tree projects on its own orthonormal random directions, one per level, and
halves a node at a threshold. The thresholds are fitted on a bounded sample;
every row is then indexed, one leaf per tree. A query opens leaves of all trees
from one priority queue, nearest cell first, until they hold a stated share of
the rows; the rows of these leaves are ranked by exact distance.

The directions of a tree are orthonormal, so a leaf's priority (the squared
distances to the half-spaces left on the way) bounds the distance to all its rows.
"""
from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import blobs, distinct_vectors, matrix, stored, unblob, vectors

#: Most rows of the sample that thresholds are fitted on.
SAMPLE_ROWS = 20_000
TREES, LEAF_ROWS, MOST_DEPTH = 4, 256, 11
#: Rows (counted once for each tree that holds them) that a query's leaves have together, as a share of all
#: rows. Vectors without any structure need about as many for a recall of 0.9; clustered ones far fewer.
SEARCH_SHARE = 1.4
#: Rows and queries of a block: a leaf, or a leaf's queries, beyond that are split.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 8192


@dataclass
class Forest:
    """directions: (trees, dim, depth); thresholds: (trees, 2**depth), a heap-ordered node each, 0 unused."""
    directions: np.ndarray
    thresholds: np.ndarray
    depth: int

    @property
    def trees(self) -> int:
        return len(self.directions)

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each row in each tree, numbered through all trees."""
        out = np.empty((len(rows), self.trees), np.int64)
        for t in range(self.trees):
            proj, node = rows @ self.directions[t], np.ones(len(rows), np.int64)
            for level in range(self.depth):
                node = 2 * node + (proj[:, level] > self.thresholds[t][node])
            out[:, t] = node - (1 << self.depth) + (t << self.depth)
        return out

    def search(self, query: np.ndarray, sizes: np.ndarray, enough: float) -> list[int]:
        """Leaves, best first over all trees, until their rows add up to ``enough``."""
        proj = np.einsum("d,tdl->tl", query, self.directions).tolist()
        thresholds, first = self.thresholds, 1 << self.depth
        heap, out, have = [(0.0, t, 1, 0) for t in range(self.trees)], [], 0
        while heap and have < enough:
            bound, t, node, level = heapq.heappop(heap)
            if node >= first:
                leaf = node - first + (t << self.depth)
                if sizes[leaf]:
                    out.append(leaf)
                    have += int(sizes[leaf])
                continue
            gap = proj[t][level] - thresholds[t, node]
            near = 2 * node + (gap > 0)
            heapq.heappush(heap, (bound, t, near, level + 1))
            heapq.heappush(heap, (bound + gap * gap, t, near ^ 1, level + 1))
        return out


def fit_forest(sample: np.ndarray, rows: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 11) -> Forest:
    """Trees as deep as ``rows`` asks for, with at least 8 sample rows a leaf."""
    dim = sample.shape[1]
    by_rows, by_sample = np.log2(max(1, rows / leaf_rows)), np.log2(max(1, len(sample) / 8))
    depth = int(max(0, min(by_rows, by_sample, MOST_DEPTH, dim)))
    directions, thresholds = np.zeros((trees, dim, depth)), np.zeros((trees, 1 << depth))
    for t in range(trees):
        rng = np.random.default_rng(seed + t)
        directions[t] = np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :depth]
        proj, node = sample @ directions[t], np.ones(len(sample), np.int64)
        for level in range(depth):
            for k in range(1 << level, 2 << level):
                here = proj[node == k, level]
                thresholds[t, k] = np.median(here) if len(here) else 0.0
            node = 2 * node + (proj[:, level] > thresholds[t][node])
    return Forest(directions, thresholds, depth)


def nearest(rows: np.ndarray, queries: np.ndarray, k: int):
    """For each query the indexes of its nearest rows, all that may be among the k best, and exact distances."""
    rough = (queries ** 2).sum(1)[:, None] + (rows ** 2).sum(1)[None, :] - 2 * queries @ rows.T
    scale = np.abs(rough).max(initial=0) + 1
    for q, r in zip(queries, rough):
        near = np.arange(len(r)) if len(r) <= k else np.flatnonzero(r <= np.partition(r, k - 1)[k - 1] + 1e-9 * scale)
        yield near, np.sqrt(((rows[near] - q) ** 2).sum(1))


def ann_search(df: DataFrame, id_col: str, vec_col: str, is_query, k: int = 10, trees: int = TREES, leaf_rows: int = LEAF_ROWS,
               share: float = SEARCH_SHARE, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS,
               block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, the row's own id left out.

    ``is_query`` is a condition on ``id``. score is the Euclidean distance of the
    original vectors in double precision; ties go to the smaller id. Vectors that
    are null, zero, of another length than most, or hold null or non-finite
    components take no part; nor do null ids. Equal vectors are indexed once, with
    as many ids as a result can show, and queried once. Repeated rows count once.
    Fewer rows than k give all of them; an empty table gives no rows.
    """
    spark = df.sparkSession
    rows = stored(vectors(df, id_col, vec_col).where(F.exists("vec", lambda x: x != 0)), "ann-rows")
    once = distinct_vectors(rows, k + 1)
    index0 = stored(once.select(F.xxhash64("vec").alias("h"), "vec", "ids"), "ann-distinct")
    n = index0.count()
    sample = [r["vec"] for r in index0.orderBy("h").limit(sample_rows).collect()] if n else []
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest = fit_forest(np.array(sample, np.float64), n, trees, leaf_rows)
    dim, shared = len(sample[0]), spark.sparkContext.broadcast(forest)     # bounded: trees x (dim x depth + 2**depth) numbers

    def place(batches):
        for b in batches:
            m = matrix(b.column("vec"))
            leaves = shared.value.leaves(m) if len(m) else np.zeros((0, shared.value.trees), np.int64)
            yield pa.RecordBatch.from_arrays([b.column("h"), blobs(m), b.column("ids"), pa.array(list(leaves), pa.list_(pa.int64()))],
                                             names=["h", "vec", "ids", "leaves"])

    index = stored(index0.mapInArrow(place, "h long, vec binary, ids array<long>, leaves array<long>"), "ann-index")
    per_leaf = index.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count()
    sizes = np.zeros(trees << forest.depth, np.int64)
    for r in per_leaf.collect():                                            # at most trees x 2**depth rows
        sizes[r["leaf"]] = r["count"]
    sizes_b = spark.sparkContext.broadcast(sizes)

    asked = rows.where(is_query).select("id", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec")).dropDuplicates(["vec", "id"])
    queries = stored(asked.select("vec").distinct().withColumn("q", F.monotonically_increasing_id()), "ann-queries")
    n_queries = queries.count()

    def open_leaves(batches):
        for b in batches:
            m = matrix(b.column("vec"))
            found = [shared.value.search(v, sizes_b.value, share * n) for v in m]
            yield pa.RecordBatch.from_arrays([b.column("q"), blobs(m), pa.array(found, pa.list_(pa.int64()))], names=["q", "vec", "leaves"])

    row_blocks = spark.createDataFrame([(i, int(-(-s // block_rows))) for i, s in enumerate(sizes.tolist()) if s], "leaf long, row_blocks long")
    query_blocks = max(1, -(-n_queries // block_queries))
    left = (index.select("h", "vec", "ids", F.explode("leaves").alias("leaf")).join(F.broadcast(row_blocks), "leaf")
            .withColumn("row_block", F.pmod("h", "row_blocks"))
            .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    right = (queries.mapInArrow(open_leaves, "q long, vec binary, leaves array<long>")
             .select("q", "vec", F.explode("leaves").alias("leaf")).join(F.broadcast(row_blocks.toDF("leaf", "blocks")), "leaf")
             .withColumn("row_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("query_block", F.pmod(F.xxhash64("q"), F.lit(query_blocks)).cast("int")))

    def rerank(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame([], columns=["q", "ids", "scores"], dtype=object)
        m, ids, out = unblob(a["vec"], dim), a["ids"].tolist(), []
        for q, (near, dist) in zip(b["q"], nearest(m, unblob(b["vec"], dim), k + 1)):
            best = sorted((d, i) for j, d in zip(near.tolist(), dist.tolist()) for i in ids[j])[:k + 1]
            out.append((q, [i for _, i in best], [d for d, _ in best]))
        return pd.DataFrame(out, columns=["q", "ids", "scores"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        best = sorted({(d, i) for i_, d_ in zip(pdf["ids"], pdf["scores"]) for i, d in zip(i_, d_)})[:k + 1]
        return pd.DataFrame({"q": [pdf["q"].iloc[0]], "best": [[{"score": d, "vec_id": i} for d, i in best]]})

    key = ["leaf", "row_block", "query_block"]
    found = (left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(rerank, "q long, ids array<long>, scores array<double>")
             .groupBy("q").applyInPandas(merge, "q long, best array<struct<score:double,vec_id:long>>"))
    return ranked(asked, queries.join(found, "q").select("vec", "best"), k)


def ranked(asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Rows of each asked (id, vec) from found (vec, best), best first, own id left out."""
    own = asked.join(found, "vec").select(F.col("id").alias("query_id"),
                                          F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("id")), 1, k).alias("best"))
    return (own.select("query_id", F.posexplode("best").alias("pos", "b"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score")))
