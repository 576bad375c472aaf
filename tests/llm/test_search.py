"""Vector searches: the forest's recall and exact distances, the M-tree against brute force."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsift.llm import ann, mtree
from jobsift.llm.queries import QUERIES


def nearest(rows, q, k):
    return sorted((math.dist(x, rows[q]), i) for i, x in rows.items() if i != q)[:k]


def highest(rows, q, k):
    f = {i: [math.floor(256 * c) for c in x] for i, x in rows.items()}
    return sorted((-sum(a * b for a, b in zip(x, f[q])), i) for i, x in f.items() if i != q)[:k]


def by_query(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in out:
        out[q].sort()
        assert [r for r, _, _ in out[q]] == list(range(1, len(out[q]) + 1))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    rows = {i: rng.normal(size=16).round(3).tolist() for i in range(2500)}
    for i in range(0, 2500, 3):
        rows[i] = rows[0]                                       # a third of all rows are one vector
    return rows, spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<float>").repartition(6)


def exact(rows):
    return {i: np.array(x, np.float32).astype(float).tolist() for i, x in rows.items()}


def test_forest_recall(frame):
    rows, df = frame
    got = by_query(ann.ann_search(df, "vec_id", "embedding", F.col("id") % 100 == 0, leaf_rows=64, block_rows=50, block_queries=10))
    rows, hit, total = exact(rows), 0, 0
    assert set(got) == set(range(0, 2500, 100))
    for q, g in got.items():
        want = nearest(rows, q, 10)
        hit += len({i for _, i in want} & {i for _, i, _ in g})
        total += 10
        assert len(g) == 10 and [(s, i) for _, i, s in g] == sorted((s, i) for _, i, s in g)
        for _, i, s in g:
            assert math.isclose(s, math.dist(rows[i], rows[q]), rel_tol=1e-12, abs_tol=1e-12)
    assert hit / total >= 0.9
    assert [i for _, i, _ in got[300]] == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27]    # ties to smaller ids


def test_mtree_is_exact(frame):
    rows, df = frame
    got = by_query(mtree.topk_inner_product(df, "vec_id", "embedding", F.col("id") % 50 == 0, subtree_rows=300, part_rows=200,
                                            page_rows=32, block_queries=20))
    rows = exact(rows)
    assert set(got) == set(range(0, 2500, 50))
    for q, g in got.items():
        assert [(-s, i) for _, i, s in g] == highest(rows, q, 5)


@pytest.mark.parametrize("name", ["op1", "op9"])
def test_edge_rows(spark, name):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1., 2.], 1), (0, [1., 2.], 1), (100, [1., 2.5], 2), (1, [-1., 0.], 3), (2, None, 4), (3, [1., None], 5), (4, [nan, 1.], 6),
            (5, [inf, 1.], 7), (6, [0., 0.], 8), (7, [1., 2., 3.], 9), (None, [1., 2.], 1), (8, [-0., 3.], 1), (9, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    good = {i: v for i, v, _ in rows if i in (0, 100, 1, 8)} | ({6: [0., 0.]} if name == "op9" else {})
    run = ann.ann_search if name == "op1" else mtree.topk_inner_product
    got = by_query(run(df, "vec_id", "embedding", F.col("id") % 100 == 0, k=10))
    assert set(got) == {0, 100}
    for q in got:
        want = nearest(good, q, 10) if name == "op1" else highest(good, q, 10)
        assert [i for _, i, _ in got[q]] == [i for _, i in want]
    assert run(df.where("false"), "vec_id", "embedding", F.col("id") % 100 == 0).count() == 0


def test_queries_on_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.vec_id: [float(x) for x in r.embedding] for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    got = by_query(QUERIES["op9_mtree_topk"](spark, sf))
    assert set(got) == {i for i in rows if i % 50 == 0}
    assert all([(-s, i) for _, i, s in g] == highest(rows, q, 5) for q, g in got.items())
    got = by_query(QUERIES["op1_rp_forest"](spark, sf))
    assert set(got) == {i for i in rows if i % 100 == 0}
    hits = [len({i for _, i in nearest(rows, q, 10)} & {i for _, i, _ in g}) for q, g in got.items()]
    assert sum(hits) >= 9 * len(hits)


@pytest.mark.parametrize("low", [-3, 0])
def test_many_roots_and_many_ties(spark, low):
    """Integer vectors of few components: most distances to routing vectors tie, and the zero vector is a query too."""
    rng = np.random.default_rng(11)
    rows = {i: (rng.integers(low, 7, 3) / 256).tolist() for i in range(3000)}
    rows[50], rows[100] = [0.0] * 3, [6 / 256] * 3
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>").repartition(5)
    got = by_query(mtree.topk_inner_product(df, "vec_id", "embedding", F.col("id") % 50 == 0, subtree_rows=10, part_rows=7, page_rows=4, block_queries=9))
    assert set(got) == set(range(0, 3000, 50))
    assert [q for q, g in got.items() if [(-s, i) for _, i, s in g] != highest(rows, q, 5)] == []


def test_tree_nodes_cover_their_rows_and_prune():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 8)) * 20
    points = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8))
    nodes = mtree.linked(mtree.build_tree(points, points[0], 32, 4))
    inner = [n for n in nodes if len(n["below"])]
    assert inner and max(len(n["below"]) for n in inner) <= 4 and sum(len(n["rows"]) for n in nodes) == 4000

    def rows_below(no):
        return np.concatenate([nodes[no]["rows"], *(rows_below(c) for c in nodes[no]["below"])]).astype(int)
    for no, n in enumerate(nodes):
        assert np.linalg.norm(points[rows_below(no)] - n["pivot"], axis=1).max() <= n["radius"] + 1e-9
        above = nodes[n["up"]]["pivot"] if n["up"] >= 0 else points[0]
        assert abs(np.linalg.norm(n["pivot"] - above) - n["parent"]) < 1e-9
    opened = []

    class Counted(dict):
        def __getitem__(self, key):
            if key == "pivot":
                opened.append(self)
            return dict.__getitem__(self, key)
    counted = [Counted(n) for n in nodes]
    for q in points[:50]:
        idx, dist = mtree.search_tree(counted, points, q, float(np.linalg.norm(q - points[0])), math.inf, 6)
        want = np.sort(np.linalg.norm(points - q, axis=1))[:6]
        assert np.allclose(np.sort(dist)[:6], want)
    assert len(opened) < 50 * len(nodes) / 4                      # most nodes cost no distance
