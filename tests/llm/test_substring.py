"""Repeated passages against a plain restatement over word tuples."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from jobsift.llm import substring


def brute(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("v", [1, 2, 3, 7, 13, 21])
def test_difference_cover(v):
    d = substring.difference_cover(v)
    assert all(any((a + s) % v in d and (b + s) % v in d for s in range(v)) for a in range(v) for b in range(v))


def test_words_of_a_block():
    texts = [b"", b"  one two\tthree\n", b"four", b"five ", b" ", "ünï\x0bcode\x85x".encode(), b"one"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    w = substring.Words(data, np.cumsum([0, *map(len, texts)]))
    assert [data[a:b].tobytes() for a, b in zip(w.starts, w.ends)] == [x for t in texts for x in t.split()]
    assert w.hashes[0] == w.hashes[-1] and len(set(w.hashes.tolist())) == len(w.hashes) - 1
    assert w.first.tolist() == [0, 0, 3, 4, 5, 5, 7, 8]


def corpus(rng, n):
    vocab = [f"w{i}" for i in range(300)]
    passages = [rng.choices(vocab, k=rng.randint(20, 90)) for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts += rng.choices(vocab, k=rng.randint(0, 60))
            if rng.random() < 0.6:
                p = rng.choice(passages)
                cut = rng.randint(0, len(p) // 2)
                parts += p[cut:] if rng.random() < 0.5 else p[:len(p) - cut]
        texts.append(rng.choice([" ", "\n", "  "]).join(parts))
    return texts + texts[:5] + ["a b " * 60, "z " * 35, "z " * 36]


def check(spark, rows, schema, window, period, **conf):
    df = spark.createDataFrame(rows, schema).repartition(5)
    df.write.mode("overwrite").parquet(conf["path"])
    df = spark.read.parquet(conf["path"])
    got = substring.remove_repeats(df, window=window, period=period).collect()
    want = [(r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows], window))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("window,period,block", [(35, 21, 4_000_000), (35, 21, 3000), (10, 3, 2000), (5, 5, 2000), (3, 1, 500)])
def test_equals_brute_force(spark, tmp_path, monkeypatch, window, period, block):
    monkeypatch.setattr(substring, "BLOCK_BYTES", block)
    texts = corpus(random.Random(window + period), 60)
    check(spark, list(enumerate(texts)), "doc_id long, text string", window, period, path=str(tmp_path / "t"))


def test_edge_rows(spark, tmp_path):
    same = " ".join(f"x{i}" for i in range(50))
    rows = [(1, same, 1), (1, same, 1), (None, "y " + same, 2), (2, None, 3), (3, "", 4), (4, " \n", 5), (5, "é " * 34, 6), (6, "q" * 200_000 + " " + "lo ng " * 30_000, 7)]
    check(spark, rows, "doc_id long, text string, n_words int", 35, 21, path=str(tmp_path / "t"))
    assert substring.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_on_table(spark):
    from jobsift.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {d.doc_id: b[:3] for d, b in zip(docs, brute([d.text for d in docs], 35))}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op7_cover_anchor_dedup"](spark, sf).collect()}
    assert got == want and any(n for _, n, _ in got.values())
