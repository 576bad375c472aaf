"""Packing: exact round trip against the tokenizer."""
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from jobsift.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)
TOK = Tokenizer.from_file(PATH)
ENC = packing.Encoder(PATH)


def brute(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(), st.sampled_from(" \n\tabcAB'sΣσİéÉÑ́  \x1c.,<|endoftext|>123½ª"))))
def test_encoder_equals_tokenizer(text):
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(ENC.encode([text])[0], "<u4").tolist() == brute(text)


@pytest.mark.parametrize("n", [1, 2, 3, 4095, 4096, 4097, 12289])
def test_piece_lengths(n):
    ls = packing.piece_lengths(n)
    assert sum(ls) == n and all(x & (x - 1) == 0 and x <= 4096 for x in ls) and ls == sorted(ls, reverse=True)


def check(pieces, texts):
    """texts: (id, text) of every row."""
    by = defaultdict(list)
    for r in pieces:
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 4096 and 1 << r.bucket == r.length
        by[r.doc_id].append(r)
    assert len({r.sequence_id for r in pieces}) == len(pieces)
    want = defaultdict(list)
    for d, t in texts:
        ids = brute(t) + [2]
        at = 0
        for n in packing.piece_lengths(len(ids)):
            want[d].append((at, n, zlib.crc32(np.asarray(ids[at:at + n], "<u4").tobytes()), len(ids)))
            at += n
    assert {d: sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rs) for d, rs in by.items()} == {d: sorted(v) for d, v in want.items()}


def test_edge_rows(spark, tmp_path):
    long = " ".join(random.Random(1).choices(["Hello", "wörld,", "it's", "x1y22", "<|endoftext|>"], k=30_000))
    rows = [(1, "Hello world", 9), (None, "no id", 8), (2, None, 7), (3, "", 6), (4, long, 5), (1, "Hello world", 9), (5, "日本 語　テ\x00スト 😀", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    out = packing.pack(df)
    check(out.collect(), [(r[0], r[1]) for r in rows])
    joined = b"".join(bytes(r.ids) for r in sorted((r for r in out.collect() if r.doc_id == 4), key=lambda r: r.start))
    assert np.frombuffer(joined, "<u4").tolist() == brute(long) + [2]
    packing.write_buckets(out, str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == out.count()
    assert packing.pack(df.where("false")).count() == 0


def test_query_on_table(spark):
    from jobsift.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(QUERIES["op4_binary_packing"](spark, sf).collect(), texts)
