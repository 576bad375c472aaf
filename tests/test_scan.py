"""Prefix scans against a plain loop, over several numbers of ranges."""
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from jobsift.operators.scan import _scan_batch, _Series, prefix_scan

SCHEMA = "k string, t long, id long, v long, w struct<a: long>"


def looped(rows):
    out, state = {}, {}
    for k, t, i, v, w in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        prev, total, last = state.get(k, (None, 0, None))
        total += v or 0
        last = w if w is not None else last
        out[i] = (prev, total, last and last[0])
        state[k] = (v, total, last)
    return out


def scanned(spark, rows, ranges):
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefix_scan(df, "k", ["t", "id"], lags=("v",), sums=("v",), lasts=("w",), ranges=ranges).collect()
    assert len({r["_pos"] for r in got}) == len(rows)
    return {r["id"]: (r["_prev_v"], r["_sum_v"], r["_last_w"] and r["_last_w"][0]) for r in got}


def rows_of(n, keys, seed=1):
    import random
    rnd = random.Random(seed)
    return [(rnd.choice(keys), rnd.randrange(5), i, rnd.choice([None, rnd.randrange(-9, 9)]), rnd.choice([None, None, None, (i,)])) for i in range(n)]


@pytest.mark.parametrize("keys", [["a"], ["a", None], list("abcdefgh")])
@pytest.mark.parametrize("ranges", [1, 9, None])
def test_scan_equals_a_loop(spark, keys, ranges):
    rows = rows_of(300, keys)
    assert scanned(spark, rows, ranges) == looped(rows)


def test_a_series_without_known_values_passes_on_what_came_before(spark):
    rows = [("a", 0, 0, 4, (7,))] + [("a", i, i, None, None) for i in range(1, 200)] + [("b", 0, 500, None, None)]
    assert scanned(spark, rows, 12) == looped(rows)


def test_empty_table_and_equal_rows(spark):
    assert scanned(spark, [], 3) == {}
    df = spark.createDataFrame([("a", 1, 1, 2, None)] * 500, SCHEMA)
    got = prefix_scan(df, "k", ["t", "id"], sums=("v",), ranges=6)
    assert sorted(r["_sum_v"] for r in got.collect()) == list(range(2, 1002, 2))
    assert got.selectExpr("shiftright(_pos, 33) AS p").distinct().count() > 3          # one row repeated is spread as well


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b", "c"]), st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.integers(0, 9))), max_size=30),
       st.lists(st.integers(1, 6), min_size=1, max_size=20))
def test_batches_of_any_size_give_the_same_scan(rows, sizes):
    import pyarrow as pa
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or ""))
    state, got, at, i = _Series(), [], 0, 0
    while at < len(rows):
        part = rows[at:at + sizes[i % len(sizes)]]
        at, i = at + len(part), i + 1
        b = pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.string()), pa.array([r[1] for r in part], pa.int64()),
                                        pa.array([r[2] for r in part], pa.int64())], names=["k", "v", "w"])
        got += list(zip(*(c.to_pylist() for c in _scan_batch(b, state, "k", ["v"], ["v"], ["w"]))))
    want, seen, first = [], {}, rows[0][0] if rows else None
    head = True
    for n, (k, v, w) in enumerate(rows):
        head = head and k == first
        prev, total, last = seen.get(k, (None, 0, None))
        seen[k] = (v, total + (v or 0), w if w is not None else last)
        want.append((prev, seen[k][1], seen[k][2], n == 0, head))
    assert got == want
