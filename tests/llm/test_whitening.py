import math
from fractions import Fraction

import numpy as np
import pytest

from jobsift.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, x string, id int"


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def whole(v):
    return tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)


def restated(vectors, weights=None):
    """n, S, falling eigenvalues and unit eigenvectors of the covariance, from exact fractions."""
    xs = sorted(set(vectors)) if weights is None else vectors
    n, dim = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(dim)]
    centred = np.array([[float(Fraction(n * x[i] - sums[i], n)) for i in range(dim)] for x in xs])
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, values[::-1], vectors_[:, ::-1]


def check(rows, got, components=16):
    took = [(i, whole(v)) for i, v in rows if usable(v)]
    n, sums, values, vectors = restated([x for _, x in took])
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    assert len(got) == len(took) * min(components, len(values))
    for i, x in took:
        for k, here in by_id[i].items():
            for r in here:
                assert r["n"] == n and abs(r["explained"] - values[k - 1] / values.sum()) <= 1e-9
                assert r["identity_error"] <= 1e-4
        assert {r["deviation"] for r in by_id[i][1]} >= {sum((n * a - s) ** 2 for a, s in zip(x, sums))}
    for k in range(min(components, len(values))):       # projections agree up to the component's sign
        want = np.array([sum(float(Fraction(n * a - s, n)) * v for a, s, v in zip(x, sums, vectors[:, k])) for _, x in took]) / math.sqrt(values[k])
        mine = np.array([by_id[i][k + 1][0]["whitened"] for i, _ in took])
        assert min(np.abs(want - mine).max(), np.abs(want + mine).max()) < 1e-6


def test_query_on_the_whole_table(spark):
    import __spark_entry__ as ent
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, ent.queries()["op12_whitening"](spark, path).collect())


def odd_rows(count=300):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=4) * [1, 2, 30, 0.2]]) for i in range(count)]
    rows += [(1000 + i, [0.5, -0.25, 3.0, 1.0]) for i in range(count)]                    # half of all rows are one vector
    return rows + [(5000, None), (5001, []), (5002, [1.0, None, 2.0, 3.0]), (5003, [1.0, math.nan, 2.0, 3.0]),
                   (5004, [1.0, math.inf, 2.0, 3.0])]


def test_odd_rows_and_partitionings(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(i, v, "clash", 7) for i, v in rows], SCHEMA)
    for parts in (1, 6):
        check(rows, W.whitened_components(df.repartition(parts), "vec_id", "embedding").collect())


def test_null_and_repeated_ids_have_a_result_each(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0], "", 1), (None, [1.0, 2.0], "", 1), (3, [4.0, 1.0], "", 1), (3, [0.0, 1.5], "", 1),
                                (4, [1.0, 2.0, 3.0], "", 1)], SCHEMA)                      # the last has another length
    got = W.whitened_components(df, "vec_id", "embedding").collect()
    assert sorted(str(r["vec_id"]) for r in got) == ["3"] * 4 + ["None"] * 4
    assert {r["n"] for r in got} == {3}


def test_weights_by_count(spark):
    rows = [(0, [0.0, 0.0])] * 6 + [(1, [4.0, 0.0]), (2, [0.0, 2.0]), (3, [4.0, 2.0])]
    df = spark.createDataFrame([(i, v, "", 1) for i, v in rows], SCHEMA)
    out, model = W.whiten(df, "vec_id", "embedding", weights="count")
    n, sums, values, _ = restated([whole(v) for _, v in rows], weights="count")
    assert model.n == n and model.sums.tolist() == sums and np.allclose(model.values, values) and model.identity_error < 1e-9
    assert out.count() == len(rows)


def test_directions_without_variance_are_left_out(spark):
    flat = spark.createDataFrame([(i, [float(i), 2.0, 2.0 * i], "", 1) for i in range(9)], SCHEMA)
    got = W.whitened_components(flat, "vec_id", "embedding").collect()
    assert {r["component"] for r in got} == {1} and len(got) == 9 and abs(got[0]["explained"] - 1) < 1e-12
    same = spark.createDataFrame([(i, [1.0, 2.0], "", 1) for i in range(5)], SCHEMA)
    assert W.whitened_components(same, "vec_id", "embedding").collect() == []


def test_empty_table_and_huge_entries(spark):
    empty = W.whitened_components(spark.createDataFrame([], SCHEMA), "vec_id", "embedding")
    assert empty.collect() == [] and empty.columns[:2] == ["vec_id", "component"]
    with pytest.raises(Exception, match="entry beyond"):
        W.whitened_components(spark.createDataFrame([(1, [1e30, 1.0], "", 1), (2, [2.0, 1.0], "", 1)], SCHEMA), "vec_id", "embedding").collect()


def test_exact_arithmetic_beyond_64_bits():
    x = np.array([[1_000_064, 999_000]])
    n, sums = 10 ** 13, np.array([10 ** 19 + 5, 10 ** 19 - 7], object)
    scaled = W.centred_times_n(x, n, sums)
    want = [n * 1_000_064 - sums[0], n * 999_000 - sums[1]]
    assert scaled.tolist() == [want] and W.deviations(scaled) == [sum(v * v for v in want)]


def test_partial_sums_meet_in_a_tree(spark):
    cells = [np.arange(4.0) * i for i in range(100)]
    df = spark.createDataFrame([(i, bytearray(c.tobytes())) for i, c in enumerate(cells)], "no long, cells binary")
    got = W._sum_matrices(df, spark, most=3)
    assert len(got) <= 3 and np.allclose(sum(np.frombuffer(c) for c in got), sum(cells))
