"""Language identification: held-out accuracy, calibration, frequencies and edge rows."""
import zlib
from collections import Counter

import numpy as np
import pytest

from jobsift.llm import langid
from jobsift.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_calibration(spark):
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op5_ftrl_langid"](spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    right = [r.lang_pred == truth[r.doc_id][0] for r in held]
    assert np.mean(right) >= 0.97
    assert abs(np.mean([r.score for r in held]) - np.mean(right)) < 0.05
    assert all(0 <= r.score <= 1 for r in rows)


def brute_counts(text):
    t = "".join(c if c.isalpha() else " " for c in text.lower())
    t = " " + "".join(c for i, c in enumerate(t) if c != " " or (i and t[i - 1] != " ")) + " "
    p = np.array([ord(c) for c in t], np.uint64)
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(p) - n + 1):
            out[int(langid._hash(*(p[i + j:i + j + 1] for j in range(n)))[0])] += 1
    return out


@pytest.mark.parametrize("slice_", [4, 7, 1 << 20])
def test_ngram_counts(monkeypatch, slice_):
    monkeypatch.setattr(langid, "SLICE", slice_)
    for text in ("a", "Hello, World 12 ñé\n\n x", "日本 語 ab", "ab" * 9 + " z"):
        used, counts = langid.ngram_counts(text)
        assert dict(zip(used.tolist(), counts.tolist())) == dict(brute_counts(text))
    assert langid.ngram_counts(None) is None and langid.ngram_counts("12 \n!") is None


def test_frequencies(spark):
    texts = ["ab ab", "ab", "12", None, "xyz"] * 30
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(40)
    n, got = langid.document_frequencies(df, "text")
    want = np.zeros(langid.BUCKETS, int)
    for t in texts:
        if t and any(c.isalpha() for c in t):
            want[list(brute_counts(t))] += 1
    assert n == 90 and (got == want).all()


def test_weights_are_sparse():
    rng = np.random.default_rng(0)
    samples = []
    for i in range(400):
        used = np.unique(np.concatenate([rng.integers(0, 2000, 30), [3000 + i % 2]]))
        samples.append((used, np.full(len(used), len(used) ** -0.5), i % 2))
    w = langid.train_ftrl(samples, 2)
    assert w[3000, 0] > w[3000, 1] and w[3001, 1] > w[3001, 0]
    assert (w != 0).mean() < 0.2


def test_edge_rows(spark):
    en, de = "the quick brown fox and the dog ", "der schnelle braune Fuchs und der Hund "
    rows = [(i, (en if i % 2 else de) * (1 + i % 3), "en" if i % 2 else "de", "x") for i in range(60)]
    rows += [(100, None, "en", "x"), (101, "", "de", "x"), (102, "12 34", "en", "x"), (None, en, "de", "x"), (1, en, "en", "x"), (103, de * 20_000, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    model = langid.fit(df)
    got = langid.identify(df, model)
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r)
    assert [by[i][0].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[100][0].score == 0
    assert by[None][0].lang_pred == "en" and by[None][0].held_out is False and by[103][0].lang_pred == "de" and len(by[1]) == 2
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3
    none = langid.fit(df.where("lang = 'zz'"))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}
    assert langid.identify(df.where("false"), model).count() == 0


def test_training_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    """Rows that share one id, and one row repeated, cannot pass the sample's bound; rare languages beyond the bound are not learned."""
    sizes = []
    monkeypatch.setattr(langid, "train_ftrl", lambda samples, n, **k: sizes.append(len(samples)) or np.zeros((langid.BUCKETS, n)))
    rows = [(1, f"text number {i} abc", "en" if i % 2 else "de") for i in range(3000)] + [(1, "one row", "fr")] * 2000
    rows += [(1, f"word{i}", f"rare{i:03d}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, rows_per_language=100, train_rows=250, most_languages=5)
    assert len(model.languages) == 5 and {"en", "de", "fr"} <= set(model.languages) and 80 <= sizes[0] <= 5 * 50
    assert langid.fit(df, rows_per_language=100, train_rows=250, most_languages=1).languages == ["fr"]


def test_without_known_languages_lettered_texts_stay(spark):
    rows = [(i, ["some text", "", None, "12 !", "ñ"][i % 5], None) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert model.languages == []
    assert langid.keep_identified(df, model).count() == 20
    told = {r.lang_pred: (r.documents, r.rejected) for r in langid.rejected_by_language(df, model).collect()}
    assert told == {"und": (50, 50)}
