"""Exact top-k by inner product with an M-tree, searched best first.

Components are turned into integers. With M the largest norm, a vector x becomes
(x, sqrt(M^2 - |x|^2)) and a query (q, 0); the distance between them falls as the
inner product grows, so the k highest inner products are the k nearest points.

The index is an M-tree. Root entries are routing vectors with covering radii;
under each, inner nodes and pages hold a routing vector, its covering radius and
its distance to the parent's, and pages also entries with their distances to the page's
routing vector. A search opens nodes from a queue by lower bound. The stored distances
and the triangle inequality rule out nodes and entries before any distance to
them is computed. Bounds get a small allowance for rounding; scores are exact.
"""
from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.ann import ranked
from jobsift.llm.common import blobs, distinct_vectors, matrix, stored, unblob, vectors

#: Rows of a root entry's subtree (aimed at), most root entries, most rows of one tree part, entries of a page.
SUBTREE_ROWS, MOST_ROOTS, PART_ROWS, PAGE_ROWS = 8192, 1024, 16_384, 512
#: Most children of an inner node.
FAN_OUT = 8
#: Rows that root routing vectors are drawn from.
SAMPLE_ROWS = 20_000
BLOCK_QUERIES = 8192
#: Share of a bound that rounding may take.
SLACK = 1e-9


def spread(points: np.ndarray, count: int) -> np.ndarray:
    """Indexes of ``count`` points far from each other (farthest first), fewer if points repeat."""
    chosen, dist = [0], np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < count and dist.max() > 0:
        chosen.append(int(dist.argmax()))
        dist = np.minimum(dist, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return np.array(chosen)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(d, 0))


def build_tree(points: np.ndarray, parent: np.ndarray, page_rows: int = PAGE_ROWS, fan_out: int = FAN_OUT) -> list[dict]:
    """The nodes of an M-tree over ``points``: routing vector, covering radius, distance to the parent's routing vector,
    the number of the parent (-1: ``parent`` itself) and, of pages, entry indexes and their distances to the routing vector."""
    open_, nodes = [(np.arange(len(points)), -1, parent)], []
    while open_:
        idx, up, above = open_.pop()
        here = points[idx]
        pivot = here[((here - here.mean(0)) ** 2).sum(1).argmin()]
        dist = np.linalg.norm(here - pivot, axis=1)
        node = {"up": up, "pivot": pivot, "radius": float(dist.max()), "parent": float(np.linalg.norm(pivot - above)),
                "rows": np.zeros(0, np.int64), "dist": np.zeros(0)}
        nodes.append(node)
        if len(idx) <= page_rows:
            node["rows"], node["dist"] = idx, dist
            continue
        seeds = here[spread(here, min(fan_out, -(-len(idx) // page_rows)))]
        if len(seeds) > 1:
            near = distances(here, seeds).argmin(1)
            parts = [idx[near == s] for s in range(len(seeds)) if (near == s).any()]
        else:
            parts = np.array_split(idx, -(-len(idx) // page_rows))
        open_ += [(p, len(nodes) - 1, pivot) for p in parts]
    return nodes


def search_tree(nodes, points, query, to_parent: float, bound: float, k: int):
    """(index, distance) of the rows that may be among the k nearest within ``bound``, from one part of the tree.

    Nodes are opened best first. A node whose stored parent distance already puts
    it beyond the bound costs no distance; nor does such an entry of a page.
    ``nodes`` have ``below``, the numbers of their children, whose parent distances and radii are ``steps`` and ``reach``.
    """
    kept_i, kept_d, heap = [], np.zeros(0), []
    slack = SLACK * (bound if math.isfinite(bound) else 1.0) + 1e-6

    def consider(below, steps, reach, known: float, least: float) -> None:
        may = np.maximum(np.abs(known - steps) - reach, least)
        for no in np.flatnonzero(may <= bound + slack).tolist():
            heapq.heappush(heap, (float(may[no]), below[no], -1.0))

    for no, n in enumerate(nodes):
        if n["up"] < 0:
            consider([no], np.array([n["parent"]]), np.array([n["radius"]]), to_parent, 0.0)
    while heap:
        least, no, known = heapq.heappop(heap)
        if least > bound + slack:
            break
        node = nodes[no]
        if known < 0:                                       # now its real lower bound
            known = float(np.linalg.norm(query - node["pivot"]))
            real = max(least, known - node["radius"])
            if heap and real > heap[0][0]:
                heapq.heappush(heap, (real, no, known))
                continue
            if real > bound + slack:
                continue
            least = real
        if len(node["below"]):
            consider(node["below"], node["steps"], node["reach"], known, least)
            continue
        may = np.flatnonzero(np.abs(known - node["dist"]) <= bound + slack)
        if not len(may):
            continue
        idx = node["rows"][may]
        dist = np.linalg.norm(points[idx] - query, axis=1)
        near = dist <= bound + slack
        kept_i.append(idx[near])
        kept_d = np.concatenate([kept_d, dist[near]])
        if len(kept_d) > k:
            bound = min(bound, float(np.partition(kept_d, k - 1)[k - 1]))
    idx = np.concatenate(kept_i) if kept_i else np.zeros(0, np.int64)
    near = kept_d <= bound + slack
    return idx[near], kept_d[near]


def linked(nodes: list[dict]) -> list[dict]:
    """``nodes`` with the numbers, parent distances and radii of each one's children."""
    below: list[list[int]] = [[] for _ in nodes]
    for no, n in enumerate(nodes):
        if n["up"] >= 0:
            below[n["up"]].append(no)
    for n, children in zip(nodes, below):
        n["below"] = children
        n["steps"], n["reach"] = np.array([nodes[c]["parent"] for c in children]), np.array([nodes[c]["radius"] for c in children])
    return nodes


def topk_inner_product(df: DataFrame, id_col: str, vec_col: str, is_query, k: int = 5, scale: float = 256.0,
                       subtree_rows: int = SUBTREE_ROWS, part_rows: int = PART_ROWS, page_rows: int = PAGE_ROWS,
                       block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score long): each query's k highest integer inner products, exactly.

    Components become floor(scale * x). ``is_query`` is a condition on ``id``; the
    row's own id is left out; ties go to the smaller id. Vectors that are null,
    of another length than most, or hold null or non-finite components take no
    part; nor do null ids. Zero vectors take part. Equal vectors are stored and
    asked once; repeated rows count once; an empty table gives no rows. Inner
    products must stay below 2^53, else an error is raised.
    """
    spark = df.sparkSession
    ints = vectors(df, id_col, vec_col).select("id", F.transform("vec", lambda x: F.floor(x * scale).cast("double")).alias("vec"))
    rows = stored(ints, "mt-rows")
    index0 = stored(distinct_vectors(rows, k + 1).select(F.xxhash64("vec").alias("h"), "vec", "ids")
                    .withColumn("norm2", F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)), "mt-distinct")
    n, top = index0.agg(F.count("*"), F.max("norm2")).head()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if top >= 2 ** 53:
        raise ValueError("inner products beyond 2^53 are not exact in double precision")

    def lifted(m: np.ndarray) -> np.ndarray:
        return np.column_stack([m, np.sqrt(np.maximum(top - (m ** 2).sum(1), 0))])

    roots_wanted = int(min(MOST_ROOTS, -(-n // subtree_rows)))
    sample = lifted(np.array([r["vec"] for r in index0.orderBy("h").limit(SAMPLE_ROWS).select("vec").collect()], np.float64))
    roots = sample[spread(sample, roots_wanted)]
    dim, roots_b = roots.shape[1] - 1, spark.sparkContext.broadcast(roots)      # at most MOST_ROOTS vectors

    def place(batches):
        for b in batches:
            m = matrix(b.column("vec"))
            d = distances(lifted(m), roots_b.value) if len(m) else np.zeros((0, len(roots_b.value)))
            near = d.argmin(1) if len(m) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("h"), blobs(m), b.column("ids"), pa.array(near.astype(np.int64)),
                                              pa.array(d[np.arange(len(d)), near] if len(m) else np.zeros(0))], names=["h", "vec", "ids", "root", "d"])

    index = stored(index0.mapInArrow(place, "h long, vec binary, ids array<long>, root long, d double"), "mt-index")
    radius, size = np.zeros(len(roots)), np.zeros(len(roots), np.int64)
    for r in index.groupBy("root").agg(F.max("d").alias("r"), F.count("*").alias("n")).collect():   # at most MOST_ROOTS rows
        radius[r["root"]], size[r["root"]] = r["r"], r["n"]
    parts = np.maximum(1, -(-size // part_rows))
    parts_of = spark.createDataFrame([(i, int(p)) for i, p in enumerate(parts.tolist())], "root long, parts long")

    def nodes_of(pdf: pd.DataFrame) -> pd.DataFrame:
        m, root = unblob(pdf["vec"], dim), int(pdf["root"].iloc[0])
        ids, out = pdf["ids"].tolist(), []
        for no, p in enumerate(build_tree(lifted(m), roots_b.value[root], page_rows)):
            out.append((root, int(pdf["part"].iloc[0]), no, p["up"], p["pivot"].tobytes(), p["radius"], p["parent"], m[p["rows"]].tobytes(),
                        p["dist"].tobytes(), [ids[i] for i in p["rows"]]))
        return pd.DataFrame(out, columns=["root", "part", "node", "up", "pivot", "radius", "parent", "entries", "dist", "ids"])

    tree = stored(index.join(F.broadcast(parts_of), "root").withColumn("part", F.pmod("h", "parts"))
                  .groupBy("root", "part").applyInPandas(nodes_of, "root long, part long, node long, up long, pivot binary, radius double, parent double, "
                                                         "entries binary, dist binary, ids array<array<long>>"), "mt-tree")

    asked = rows.where(is_query).select("id", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec")).dropDuplicates(["vec", "id"])
    queries = stored(asked.select("vec").distinct().withColumn("q", F.monotonically_increasing_id()), "mt-queries")
    query_blocks = int(max(1, -(-queries.count() // block_queries)))

    def home(batches):
        """Each query's root entries: the nearest only, with no bound yet."""
        for b in batches:
            m = matrix(b.column("vec"))
            d = distances(np.column_stack([m, np.zeros(len(m))]), roots_b.value) if len(m) else np.zeros((0, len(roots)))
            d = np.where(size[None, :] > 0, d, np.inf)
            yield pa.RecordBatch.from_arrays([b.column("q"), blobs(m), pa.array([[r] for r in d.argmin(1).tolist()] if len(m) else [], pa.list_(pa.int64())),
                                              pa.array(np.full(len(m), np.inf))], names=["q", "vec", "roots", "bound"])

    def others(batches):
        """The root entries that can still hold a better row than the k-th found, without the one already searched."""
        for b in batches:
            m, bound = unblob(b.column("vec").to_pylist(), dim), np.asarray(b.column("bound"))
            d = distances(np.column_stack([m, np.zeros(len(m))]), roots_b.value) if len(m) else np.zeros((0, len(roots)))
            may = (np.maximum(d - radius[None, :], 0) <= bound[:, None] * (1 + SLACK) + 1e-6) & (size[None, :] > 0)
            may[np.arange(len(m)), np.asarray(b.column("home"), np.int64)] = False
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("vec"), pa.array([np.flatnonzero(x) for x in may], pa.list_(pa.int64())),
                                              b.column("bound")], names=["q", "vec", "roots", "bound"])

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame([], columns=["q", "vec", "home", "ids", "scores"], dtype=object)
        a = a.sort_values("node")
        entries = [np.frombuffer(x, np.float64).reshape(-1, dim) for x in a["entries"]]
        starts = np.cumsum([0, *map(len, entries)])
        plain, ids = np.concatenate(entries), [i for x in a["ids"] for i in x]
        points = lifted(plain)
        nodes = linked([{"up": int(u), "pivot": np.frombuffer(p, np.float64), "radius": r, "parent": d, "rows": np.arange(s, e), "dist": np.frombuffer(x, np.float64)}
                        for u, p, r, d, x, s, e in zip(a["up"], a["pivot"], a["radius"], a["parent"], a["dist"], starts, starts[1:])])
        root, out = int(a["root"].iloc[0]), []
        parent = roots_b.value[root]
        for q, raw, bound in zip(b["q"], b["vec"], b["bound"]):
            v = np.frombuffer(raw, np.float64)
            query = np.append(v, 0.0)
            idx, _ = search_tree(nodes, points, query, float(np.linalg.norm(query - parent)), bound, k + 1)
            score = plain[idx] @ v
            best = sorted((-int(s), i) for j, s in zip(idx.tolist(), score.tolist()) for i in ids[j])[:k + 1]
            out.append((q, raw, root, [i for _, i in best], [-s for s, _ in best]))
        return pd.DataFrame(out, columns=["q", "vec", "home", "ids", "scores"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        best = sorted({(-s, i) for i_, s_ in zip(pdf["ids"], pdf["scores"]) for i, s in zip(i_, s_)})[:k + 1]
        raw = pdf["vec"].iloc[0]
        v = np.frombuffer(raw, np.float64)
        # The distance at which the (k+1)-th score lies: |q|^2 + M^2 - 2 score.
        bound = math.sqrt(max(float(v @ v) + top + 2 * best[k][0], 0.0)) if len(best) > k else math.inf
        return pd.DataFrame({"q": [pdf["q"].iloc[0]], "vec": [raw], "home": [pdf["home"].iloc[0]], "bound": [bound], "ids": [[i for _, i in best]], "scores": [[-s for s, _ in best]]})

    key = ["root", "part", "query_block"]
    left = tree.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def visit(sent: DataFrame) -> DataFrame:
        right = (sent.select("q", "vec", "bound", F.explode("roots").alias("root")).join(F.broadcast(parts_of), "root")
                 .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
                 .withColumn("query_block", F.pmod(F.xxhash64("q"), F.lit(query_blocks)).cast("int")))
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(search, "q long, vec binary, home long, ids array<long>, scores array<long>")

    sent = "q long, vec binary, roots array<long>, bound double"
    merged = "q long, vec binary, home long, bound double, ids array<long>, scores array<long>"
    first = stored(visit(queries.mapInArrow(home, sent)).groupBy("q").applyInPandas(merge, merged), "mt-first")
    again = visit(first.select("q", "vec", "home", "bound").mapInArrow(others, sent))
    every = again.union(first.select("q", "vec", "home", "ids", "scores"))
    found = every.groupBy("q").applyInPandas(merge, merged).select(
        "q", F.arrays_zip(F.col("scores").alias("score"), F.col("ids").alias("vec_id")).alias("best"))
    return ranked(asked, queries.join(found, "q").select("vec", "best"), k)
