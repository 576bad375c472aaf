"""Scans along series, cut into ranges, against a brute-force restatement."""
import datetime as dt
import random

import pytest

from jobsift.plans import metrics


def make_samples(spark, n=400, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1, 0, 50, 0)
    rows, t = [], t0
    for i in range(n):
        t = t + dt.timedelta(seconds=rnd.choice([5, 30, 61, 170, 299, 300, 301, 900, 3500]))
        rows.append((i, rnd.choice([1, 2]) if i % 3 else 1, t, round(rnd.uniform(0, 50), 2)))
    return spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, value double"), rows


def brute_rates(rows, window=300):
    out = {}
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for series in by.values():
        series.sort(key=lambda r: r[2])
        cents = [round(r[3] * 100) for r in series]
        for i, r in enumerate(series):
            tot = 0
            for k in range(1, i + 1):
                lo = r[2] - dt.timedelta(seconds=window)
                if series[k - 1][2] > lo and series[k][2] > lo:
                    tot += cents[k] - cents[k - 1] if cents[k] >= cents[k - 1] else cents[k]
            out[r[0]] = tot
    return out


@pytest.mark.parametrize("ranges", [1, 13])
def test_counter_rate_matches_brute_force(spark, ranges):
    df, rows = make_samples(spark)
    got = {r["event_id"]: r["rate_cents"] for r in metrics.counter_rate(df, ranges=ranges, scale=2).collect()}
    assert got == brute_rates(rows)


def test_rates_do_not_depend_on_ranges_or_lose_decimals(spark):
    df, rows = make_samples(spark)
    for ranges in (1, 4, 60):
        got = {r["event_id"]: r["rate_cents"] for r in metrics.counter_rate(df, window_seconds=9000, ranges=ranges, scale=2).collect()}
        assert got == brute_rates(rows, window=9000)
    fine = spark.createDataFrame([(i, 1, r[2], i * 0.001) for i, r in enumerate(rows[:5])], df.schema)
    last = metrics.counter_rate(fine, window_seconds=10**6).orderBy("event_id").collect()[-1]
    assert abs(last["rate"] * 10**6 - 0.004) < 1e-12


def test_gap_breaks_a_run(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, 1, t0 + dt.timedelta(minutes=m), 99.0) for i, m in enumerate((0, 3, 6, 186, 187))],
                               "event_id long, user_id long, ts timestamp_ntz, value double")
    assert [r["n"] for r in metrics.sustained_threshold(df, 25.0, 300, "x").collect()] == [5]
    for ranges in (1, 3):
        got = metrics.sustained_threshold(df, 25.0, 300, "x", max_gap_seconds=600, ranges=ranges).collect()
        assert [(r["n"], r["end"]) for r in got] == [(3, t0 + dt.timedelta(minutes=6))]


def test_sustained_threshold_matches_brute_force(spark):
    df, rows = make_samples(spark)
    got = sorted((r["user_id"], r["start"], r["end"], r["n"])
                 for r in metrics.sustained_threshold(df, 25.0, 300, "warning", ranges=7).collect())
    want = []
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for uid, series in by.items():
        series.sort(key=lambda r: r[2])
        run = []
        for r in series + [None]:
            if r is not None and r[3] > 25.0:
                run.append(r)
                continue
            if run and (run[-1][2] - run[0][2]).total_seconds() >= 300:
                want.append((uid, run[0][2], run[-1][2], len(run)))
            run = []
    assert got == sorted(want)


def test_with_previous_crosses_ranges(spark):
    df, rows = make_samples(spark, n=120)
    out = metrics.with_previous(df, "user_id", "ts", ["value"], ranges=9).select("event_id", "_prev_value").collect()
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    want = {}
    for series in by.values():
        series.sort(key=lambda r: r[2])
        for i, r in enumerate(series):
            want[r[0]] = series[i - 1][3] if i else None
    assert {r["event_id"]: r["_prev_value"] for r in out} == want


def test_one_hot_minute_is_spread_over_ranges_and_has_one_answer(spark):
    """All samples of a series within one minute, many at the same time: no task holds the series, all partitionings agree."""
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, 1, t0 + dt.timedelta(milliseconds=rnd.randrange(0, 60_000, 7)), float(rnd.randrange(0, 90))) for i in range(6000)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, value double")
    spread = metrics.with_previous(df, "user_id", "ts", ["value"], ("event_id",), ranges=8)
    sizes = [r[0] for r in spread.selectExpr("shiftright(_pos, 33) AS part").groupBy("part").count().selectExpr("`count`").collect()]
    assert len(sizes) == 8 and max(sizes) < 2500
    ordered = sorted(rows, key=lambda r: (r[2], r[0]))
    cents = [round(r[3] * 100) for r in ordered]
    times = [r[2] for r in ordered]
    steps = [(times[k - 1], times[k], cents[k] - cents[k - 1] if cents[k] >= cents[k - 1] else cents[k]) for k in range(1, len(rows))]
    some = set(rnd.sample(range(len(rows)), 200))
    win = dt.timedelta(seconds=2)
    want = {ordered[k][0]: sum(inc for a, b, inc in steps if a > times[k] - win and b <= times[k]) for k in some}
    for ranges in (1, 8):
        got = {r["event_id"]: r["rate_cents"] for r in metrics.counter_rate(df, window_seconds=2, scale=2, ranges=ranges).collect()}
        assert len(got) == len(rows) and {k: got[k] for k in want} == want
    runs = [sorted(map(tuple, metrics.sustained_threshold(df, 4.0, 0, "x", ranges=r).collect())) for r in (1, 8)]
    fired = [sorted(map(tuple, metrics.fired_alerts(df, 4.0, 0.05, "x", ranges=r).collect())) for r in (1, 8)]
    assert runs[0] == runs[1] and fired[0] == fired[1] and runs[0] and fired[0]
