"""The pipeline, stage by stage, against plain restatements."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from jobsift.llm import packing
from jobsift.llm.common import stored, table
from tests.llm.test_mixing import brute_targets
from tests.llm.test_pii import brute as personal
from tests.llm.test_simhash import brute_fingerprint, brute_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(stored(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_languages(stages):
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "personal_data", "source_mix", "pack"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    before, after = rows(stages[0]), rows(stages[1])
    assert all(before[d] == r for d, r in after.items())
    assert len(after) >= 0.97 * len(before)
    assert all(any(c.isalpha() for c in r.text) for r in after.values())


def test_near_dedup(stages):
    before, after = sorted(rows(stages[1]).values()), rows(stages[2])
    labels = brute_groups([brute_fingerprint(r.text) for r in before], 2)
    assert set(after) == {before[i].doc_id for i in set(labels)}
    assert all(after[r.doc_id] == r for r in before if r.doc_id in after)


def test_personal_data(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert set(before) == set(after)
    for d, r in before.items():
        spans = personal(r.text)
        if spans:
            assert after[d].text != r.text and not personal(after[d].text) and after[d].n_chars == len(after[d].text)
            first = min(a for _, a, _ in spans)
            assert after[d].text[:max(0, first - 40)] == r.text[:max(0, first - 40)]
    assert sum(after[d].text != r.text for d, r in before.items() if not personal(r.text)) <= 0.02 * len(before)


def test_source_mix(stages):
    before, after = rows(stages[3]), stages[4].collect()
    sizes, got = Counter(), Counter()
    for r in before.values():
        sizes[r.source] += len(r.text.encode().split())
    copies = Counter()
    for r in after:
        assert r == before[r.doc_id]
        copies[r.doc_id] += 1
        got[r.source] += len(r.text.encode().split())
    want = brute_targets(sizes)
    assert max(copies.values()) <= 3
    assert all(abs(got[s] - want[s]) <= 0.15 * want[s] for s in sizes)


def test_pack(stages):
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = defaultdict(list)
    for r in stages[4].collect():
        texts[r.doc_id].append(r.text)
    pieces = stages[5].collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces) and all(p.offset == 0 for p in pieces)
    by = defaultdict(Counter)
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        by[p.doc_id][p.start, bytes(p.ids)] += 1
    for d, ts in texts.items():
        ids = tok.encode(ts[0], add_special_tokens=False).ids + [2]
        raw = np.asarray(ids, "<u4").tobytes()
        assert sum(len(b) * n for (_, b), n in by[d].items()) == len(raw) * len(ts)
        assert all(raw[4 * at:4 * at + len(b)] == b and n == len(ts) for (at, b), n in by[d].items())
    assert set(by) == set(texts)


def test_registered(spark, stages):
    import __spark_entry__ as entry
    assert entry.queries()["pipeline"](spark, SF).count() == stages[-1].count()


def test_empty_table(spark, stages):
    docs = stages[0].where("false")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


@pytest.mark.parametrize("name", ["near_dedup", "personal_data", "source_mix"])
def test_splits_of_a_later_read(spark, tmp_path, name):
    """The stage's result is planned under other splits than its decisions were."""
    texts = {"near_dedup": lambda i: f"group {i // 2} has number {i // 2 * 7919} and these words follow it {i // 2 * 104729}",
             "personal_data": lambda i: f"write to user{i}@host{i}.com today" if i % 2 else f"nothing in row {i}",
             "source_mix": lambda i: "w " * (i % 40 + 1)}
    docs = spark.createDataFrame([(i, texts[name](i), f"s{i % 3}", 1) for i in range(120)], "doc_id long, text string, source string, n_chars int")
    docs.repartition(6).write.parquet(str(tmp_path / "docs"))
    stage, results = dict(cp.STAGES)[name], []
    keys = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes")
    try:
        spark.conf.set(keys[1], 1)
        for decided, joined in ((1, 1), (1, 6), (6, 1)):
            spark.conf.set(keys[0], decided)
            out = stage(spark, spark.read.parquet(str(tmp_path / "docs")), SF)
            spark.conf.set(keys[0], joined)
            results.append(sorted(out.collect()))
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert results[0] and results[1] == results[0] and results[2] == results[0]
