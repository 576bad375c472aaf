"""SimHash fingerprints, links and groups against brute force."""
import random

import pytest
import xxhash

from jobsift.llm import simhash
from jobsift.llm.components import connected_components


def brute_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def unsigned(x):
    return x & (1 << 64) - 1


def brute_groups(fps, radius):
    """label per item: the smallest index reachable."""
    lab = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if bin(fps[i] ^ fps[j]).count("1") <= radius and lab[j] < lab[i]:
                    lab[i], changed = lab[j], True
    return lab


@pytest.mark.parametrize("text", ["", " \t\n", "one", "One two", "a b c", "Ünï çode ÄÖ x y z ÄÖ x y z",
                                  " ".join(random.Random(1).choices("abcdef", k=500)), "x " * 70000])
def test_fingerprint(text):
    assert unsigned(simhash.fingerprint(text.encode())) == brute_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_groups_match_brute_force(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = list(base)
    for b in base:                                    # chains of 1 to 3 flipped bits
        for _ in range(4):
            for _ in range(rng.randint(1, 3)):
                b ^= 1 << rng.randrange(64)
            fps.append(b)
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.fingerprint_links(df, radius)
    for r in links.collect():
        assert bin(unsigned(r.u) ^ unsigned(r.v)).count("1") <= radius
    got = {r.node: r.root for r in connected_components(links).collect()}
    want = brute_groups([unsigned(f) for f in fps], radius)
    assert [got.get(f, f) for f in fps] == [fps[i] for i in want]


def test_components_long_chain(spark):
    rows = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_edge_rows(spark):
    text = "alpha beta gamma delta epsilon zeta"
    rows = [(3, text, 1), (1, text.upper(), 2), (None, text, 3), (3, text, 1), (5, None, 4), (6, "", 5), (None, "other words here", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int").withColumnRenamed("component_id", "root")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_groups(df).collect()), key=str)
    f, o = f"{brute_fingerprint(text):016x}", f"{brute_fingerprint('other words here'):016x}"
    assert got == sorted([(3, f, 1), (1, f, 1), (None, f, 1), (3, f, 1), (5, "0" * 16, 5), (6, "0" * 16, 5), (None, o, None)], key=str)
    assert simhash.simhash_groups(df.where("false")).count() == 0
    kept = simhash.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.root) for r in kept.collect()), key=str) == [(1, 2), (5, 4), (None, 6)]


def test_query_on_table(spark):
    from jobsift.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs.sort()
    fps = [brute_fingerprint(t) for _, t in docs]
    lab = brute_groups(fps, 2)
    want = {d: (f"{f:016x}", docs[i][0]) for (d, _), f, i in zip(docs, fps, lab)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash_dedup"](spark, sf).collect()}
    assert got == want
