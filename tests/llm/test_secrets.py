"""Secret scan: automata and spans against Python's regular expressions."""
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobsift.llm import automaton, secrets

SCAN = secrets.SecretScanner()


def brute(text):
    """(start, rule, end) by re, in code points."""
    out = []
    for no, r in enumerate(secrets.RULES):
        for m in re.finditer(r.pattern, text, re.A):
            size = m.end() - m.start()
            if r.value_only:
                size = len(re.search(r"""[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""", re.sub(r"^\w+", "", m[0], count=1))[1])
            if size >= r.least:
                out.append((m.start(), no, m.end()))
    return sorted(out)


PARTS = ["password", "PassWD", "secret", "toKEN", "api_key", "APIkey", '"', "'", " ", "  ", ":", "=", "abcdef0123456789", "0123456789abcdef0",
         "deadbeef", "AKIA", "AKIAABCDEFGHIJKLMN", "ZZ99", "\n", ",", "é", "日", "\0", "ghp_", "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5p6Q7r8", "xoxb-",
         "12345678901-", "AIza", "eyJhbGciOi", ".", "eyJzdWIiOi", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN ", "PRIVATE KEY-----", "x", "-"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14), max_size=4))
def test_spans_equal_re(docs):
    texts = ["".join(d) for d in docs]
    assert SCAN.scan([t.encode() for t in texts]) == [brute(t) for t in texts]


@pytest.mark.parametrize("pattern", ["ab?c*", "(a|bc)+d", "[a-c]{2,4}x", "(?i:aB)[^\\x61]", "a{3}|a{2}b", "(ab){0,2}c", "x(y|)z"])
def test_automaton_equals_re(pattern):
    rng = random.Random(1)
    a = automaton.compile_rules([pattern], anywhere=False)
    table, accepts = a.table.tolist(), a.accepts.tolist()
    plain = pattern.replace("(?i:aB)", "[aA][bB]")
    for _ in range(2000):
        t = "".join(rng.choices("abcdxyzAB", k=rng.randint(0, 7)))
        s = 0
        for c in t.encode():
            s = table[s + c]
        assert bool(accepts[s >> 8]) == bool(re.fullmatch(plain, t)), (pattern, t)


def test_lanes_equal_one_pass():
    rng = random.Random(2)
    data = "".join(rng.choices(PARTS, k=4000)).encode() + b"a" * 5000
    data = np.frombuffer(data, np.uint8)
    table, s, want = SCAN.scanner.auto.table.tolist(), 0, []
    for c in data.tolist():
        s = table[s + c]
        want.append(s)
    for lanes in (1, 3, 100, 8192):
        assert automaton.Scanner(SCAN.scanner.auto, lanes).states(data).tolist() == want


def test_minimal():
    a = automaton.compile_rules(["abc|xbc|abc"], anywhere=False)
    assert a.states == 5                                        # start, after a or x, after b, end, dead


def digest_of(text):
    spans = brute(text or "")
    kinds = [r.kind for r in secrets.RULES]
    name = [f"{kinds[r]}:{a}:{b}" for a, r, b in spans]
    base = ",".join(n for n, (_, r, _) in zip(name, spans) if r < 3)
    return ([sum(r == k for _, r, _ in spans) for k in range(3)], hashlib.sha256(base.encode()).hexdigest(), ",".join(name))


def test_edge_rows_and_query(spark):
    from jobsift.llm.queries import QUERIES
    rows = [(1, "token=abcdefghijkl", "x"), (None, "é password: 'hunter2hunter2'", "y"), (2, None, "z"), (3, "", "z"), (1, "token=abcdefghijkl", "x"),
            (4, "0123456789abcdef" * 200_000, "long"), (5, "secret=short token token=abcsecret:abcdefabcdefabcdef", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = secrets.find_secrets(df)
    got = [(r.doc_id, [r.n_assign, r.n_access, r.n_hex], r.base_sha256, r.spans) for r in found.select("doc_id", *secrets.digest(found)).collect()]
    assert sorted(got, key=str) == sorted([(d, *digest_of(t)) for d, t, _ in rows], key=str)
    assert secrets.find_secrets(df.where("false")).count() == 0
    sf = "/root/testdata/sf0.001"
    want = {r.doc_id: digest_of(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: ([r.n_assign, r.n_access, r.n_hex], r.base_sha256, r.spans) for r in QUERIES["op6_secret_automaton"](spark, sf).collect()}
    assert got == want and any(sum(n) for n, _, _ in got.values())


@pytest.mark.parametrize("piece", ["eyJ", "password", "token=", "ghp_", "-----BEGIN ", "AKIA", "eyJa.", "secret   ", "xoxb-a", "0123456789abcde "])
def test_long_adversarial_texts_take_linear_time(piece):
    """Starts that lead nowhere, or far, do not make a stretch be read again: a megabyte takes seconds."""
    import time
    for tail in ("", ".beyJa.eyJb.c", " PRIVATE KEY-----"):
        small = piece * 300 + tail
        assert SCAN.scan([small.encode()]) == [brute(small)]
        text = (piece * (1_000_000 // len(piece)) + tail).encode()
        t0 = time.perf_counter()
        SCAN.scan([text])
        assert time.perf_counter() - t0 < 15


@pytest.mark.parametrize("pattern", ["ab?c*", "(a|bc)+d", "[a-c]{2,4}x", "a{3}|a{2}b", "x(y|)z", "a[ab]*c"])
def test_match_starts_equal_re(pattern):
    rng = random.Random(3)
    a = automaton.compile_rules([pattern], anywhere=True, backwards=True)
    table, accepts = a.table.tolist(), a.accepts.tolist()
    for _ in range(500):
        t = "".join(rng.choices("abcdxyz", k=rng.randint(0, 12)))
        assert automaton.match_starts(table, accepts, t.encode()) == [i for i in range(len(t)) if re.compile(pattern).match(t, i)], (pattern, t)
