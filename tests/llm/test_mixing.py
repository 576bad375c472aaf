"""Mixing: targets against a plain restatement; dependent rounding near target and unbiased."""
import re
from collections import Counter

import numpy as np

from jobsift.llm import mixing

SF = "/root/testdata/sf0.001"


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """{source: size} -> {source: target}"""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stop = sum(sizes.values()), set()
    while True:
        rest = sum(w[s] for s in order if s not in stop)
        left = total - sum(cap * sizes[s] for s in stop)
        t = {s: cap * sizes[s] if s in stop else left * w[s] / rest for s in order}
        more = {s for s in order if t[s] > cap * sizes[s]}
        if not more:
            return t
        stop |= more


def check(rows, texts, share=0.01):
    """texts: (source, text); rows: the mix."""
    sizes = Counter()
    for s, t in texts:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, got = brute_targets(sizes), Counter()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.taken == r.copies * r.size and r.taken <= 3 * r.size and r.source_size == sizes[r.mix_source]
        assert abs(r.target - want[r.mix_source]) <= 1e-9 * max(1, want[r.mix_source])
        got[r.mix_source] += r.taken
    for s in sizes:
        assert abs(got[s] - want[s]) <= share * want[s], (s, got[s], want[s])


def test_targets_are_met(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r.source, r.text) for r in docs.collect()]
    a = mixing.mix(docs).collect()
    check(a, texts, share=0.05)
    b = mixing.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in a) == sorted((r.doc_id, r.taken) for r in b)


def test_reduction_tree(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.pareto(1.2) * 10 + 1), "hot" if i % 3 else f"s{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, block_rows=300, left=64, fan_in=3).collect()
    check(out, [(r[2], r[1]) for r in rows], share=0.002)
    assert len({r.doc_id for r in out}) == 3000


def test_rounding_is_unbiased():
    rng = np.random.default_rng(1)
    size, p = np.sort(rng.integers(1, 60, 200))[::-1].astype(float), rng.random(200)
    mean = np.zeros(200)
    for _ in range(3000):
        u = rng.random(400)
        half = mixing.pivot_pairs(size, p, u[:200], 100)
        assert abs(half @ size - p @ size) < 1e-9 and ((half > 0) & (half < 1)).sum() <= 101
        whole = mixing.settle(size, half, u[200:])
        assert abs(whole @ size - p @ size) <= 2 * size[-1] and set(whole) <= {0.0, 1.0}
        mean += whole / 3000
    assert np.abs(mean - p)[:100].max() < 0.06


def test_settle_prefers_the_words():
    size, p = np.array([100.0, 10, 10, 10]), np.full(4, 0.4)
    for u in np.random.default_rng(2).random((50, 4)):
        assert abs(mixing.settle(size, p, u) @ size - p @ size) <= 26


def test_edge_rows(spark):
    rows = [(1, "a b c", None, 1), (None, "d e", "x", 2), (2, None, "x", 3), (3, "", "empty", 4), (1, "a b c", None, 1), (4, "w " * 50000, "é", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    out = mixing.mix(df).collect()
    assert len(out) == 6 and {r.mix_source: r.target for r in out}["empty"] == 0
    many = mixing.mixed_documents(df)
    assert many.columns == df.columns
    copies = Counter((r.doc_id, r.source) for r in many.collect())
    assert copies[(2, "x")] == copies[(3, "empty")] == 1
    assert mixing.mix(df.where("false")).count() == 0 and mixing.mixed_documents(df.where("false")).count() == 0


def test_a_repeated_row_spreads_over_blocks(spark):
    """Null ids and one size: a third of the table per source, split and drawn one by one."""
    rows = [(None, f"w{'x' * (i % 2)} " * 3, f"s{i % 3}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seen = []

    def counted(seed, left, node=mixing._node):
        run = node(seed, left)

        def checked(pdf):
            assert len(pdf) <= 600, len(pdf)
            return run(pdf)
        return checked
    original, mixing._node = mixing._node, counted
    try:
        a = mixing.mix(df, block_rows=200, left=32, fan_in=4).collect()
        b = mixing.mix(df.repartition(7), block_rows=200, left=32, fan_in=4).collect()
    finally:
        mixing._node = original
    check(a, [(r[2], r[1]) for r in rows])
    assert Counter((r.mix_source, r.taken) for r in a) == Counter((r.mix_source, r.taken) for r in b)
    assert len({r.taken for r in a if r.mix_source == "s0"}) == 2 and not seen
