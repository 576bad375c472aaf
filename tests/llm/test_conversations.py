import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from jobsift.llm import conversations as C

SCHEMA = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()),
                     StructField("text", StringType())])
SOUND = re.compile(r"(s?(ua)+)?\Z")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def all_edits(rows, faults, most_inserts):
    """(cost, audit, repaired rows) of every sequence of edits with at most so many inserted turns in a gap."""
    gap = [[("I" * k, 2 * k, list(c)) for c in itertools.product((("user", ""), ("assistant", "")), repeat=k)] for k in range(most_inserts + 1)]
    gaps = [g for by_size in gap for g in by_size]
    options = [gaps]
    for (role, text), fault in zip(rows, faults):
        stay = fault == "truncated"
        here = [("D", 3, [])]
        if fault not in ("blank", "duplicate"):
            here += [("K", stay, [(role, text)]), ("R", 2 + stay, [("user", text)]), ("R", 2 + stay, [("assistant", text)])]
        options += [here, gaps]
    for choice in itertools.product(*options):
        done = [r for c in choice for r in c[2]]
        if SOUND.match("".join(role[:1] for role, _ in done)):
            yield sum(c[1] for c in choice), "".join(c[0] for c in choice), done


def brute(rows, most_inserts=1):
    return min(all_edits(rows, faults_of(rows), most_inserts), key=lambda e: e[:2])


def searched(rows, segment=99):
    """The library's search and chain without Spark, in segments of so many rows."""
    codes = [C.row_code(r[:1], f in ("blank", "duplicate"), f == "truncated") for (r, _), f in zip(rows, faults_of(rows))]
    ways = {C.START: (0, None)}
    for i in range(0, len(codes), segment):
        ways = C.chain(ways, C.solve_segment("".join(codes[i:i + segment])))
    return min((ways[s][0], "".join(a for _, a in C.parts_of(ways[s]))) for s in C.SOUND if s in ways)


row = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "s"]), st.sampled_from(["Yes.", "No", "", " \t", "Well?", "Hm"]))


@settings(max_examples=120, deadline=None)
@given(st.lists(row, max_size=4))
def test_search_finds_the_cheapest_edits_and_the_least_audit(rows):
    cost, audit, _ = brute(rows)
    assert searched(rows) == (cost, audit)


@settings(max_examples=60, deadline=None)
@given(st.lists(row, max_size=3))
def test_two_inserted_turns_in_a_gap_are_never_better(rows):
    assert brute(rows, 2)[:2] == brute(rows, 1)[:2]


@settings(max_examples=100, deadline=None)
@given(st.lists(row, max_size=40), st.integers(1, 7))
def test_segments_give_the_result_of_the_whole(rows, segment):
    assert searched(rows, segment) == searched(rows)


def test_search_does_not_rest_on_tight_bounds(monkeypatch):
    """With bounds of zero the dominance tables and the incumbent alone prove the same result."""
    rows = [("user", "a."), ("user", "b"), ("system", "c."), ("assistant", ""), ("user", "a."), ("assistant", "d."), ("tool", "e")]
    want = searched(rows)
    C._solve_known.cache_clear()
    monkeypatch.setattr(C, "suffix_bounds", lambda rows, end: [[0] * 4 for _ in range(len(rows) + 1)])
    assert searched(rows) == want
    C._solve_known.cache_clear()


def test_long_segment_is_searched_in_linear_time():
    rows = [(("user", "assistant", "system", "tool")[(i * 7 + i // 3) % 4], f"{i}" + ".?x"[i % 3]) for i in range(1024)]
    codes = "".join(C.row_code(r[:1], f in ("blank", "duplicate"), f == "truncated") for (r, _), f in zip(rows, faults_of(rows)))
    import time
    t0 = time.perf_counter()
    C.solve_segment(codes)
    assert time.perf_counter() - t0 < 10


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        s = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        code = zlib.crc32(f"{s[0]}:{s[1]}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", s[3]) if code == 2 else s[3]
        out += [(conv, turn, "user" if code == 4 else s[2], text)] * (2 if code == 3 else 1)
    return out


def expected(rows):
    by_conv = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by_conv[r[0]].append(r)
    out = {}
    for conv, got in by_conv.items():
        got.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = faults_of([r[2:] for r in got])
        turns = [r[1] for r in got if r[1] is not None]
        cost, audit = searched([r[2:] for r in got])
        done, state, left = [], C.START, iter([r[2:] for r in got])
        for action, role, text in C.edit_rows(audit, state, left):
            if action != "delete":
                done.append(f"{role}:{text}")
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(got, got[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(done).encode()).hexdigest())
    return out


def reported(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = df.collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in got}


def test_query_equals_a_restatement_on_the_whole_table(spark):
    import __spark_entry__ as ent
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = reported(ent.queries()["op11_conversation_repair"](spark, path))
    assert got == expected(rows) and len(got) == len({r[0] for r in rows})


def odd_rows():
    rows = [(1, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(30)]
    rows += [(2, None, None, None), (2, None, "user", "x."), (2, 5, "", "y."), (2, 5, "tool", "z"), (2, 9, "user", "")]
    rows += [(None, 1, "user", "q?"), (None, 2, "assistant", "a!"), (None, None, "assistant", "a!")]
    rows += [(3, 7, "user", "same.")] * 40                                   # repeated rows
    rows += [(4, t, "user", "w" * 5000 + ".") for t in range(3)]             # long texts
    rows += [(6, t, r, x) for t in (1, 2) for r in ("user", "assistant") for x in ("b.", "a.", "c")]   # ties
    return rows + [(c, 0, "user", "gone.") for c in range(100, 160)]         # some lose their only row


def test_odd_rows_hot_conversation_and_partitionings(spark):
    rows = odd_rows() + [(7, t, ("user", "assistant")[(t * t) % 3 % 2], f"turn {t % 90}" + ".?,"[t % 3]) for t in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("seg", F.lit(1)).withColumn("n", F.lit("x"))      # clashing names
    want = expected(rows)
    for parts, bits in ((1, 10), (5, 4)):
        assert reported(C.repair_report(df.repartition(parts), segment_bits=bits)) == want


def test_repaired_rows_are_sound_and_follow_the_audit(spark):
    rows = odd_rows()
    done = C.repair(C.damage(spark.createDataFrame(rows, SCHEMA)), 3)
    audits = {r["conv_id"]: r["audit"] for r in done.conversations.collect()}
    by_conv = {}
    for r in C.repaired_rows(done).orderBy("conv_id", "seg", "position").collect():
        by_conv.setdefault(r["conv_id"], []).append(r)
    assert set(by_conv) == set(audits)
    for conv, edits in by_conv.items():
        assert "".join(e["action"][0].upper() for e in edits) == audits[conv]
        kept = [e for e in edits if e["action"] != "delete"]
        assert SOUND.match("".join(e["role"][:1] for e in kept))
        assert all(e["text"].strip() or e["action"] == "insert" for e in kept)


def test_empty_table(spark):
    assert C.repair_report(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("kept", ["D", "K"])
def test_a_truncated_turn_stays_where_that_is_cheaper(kept):
    rows = [("user", "a."), ("assistant", "b")] if kept == "K" else [("user", "a"), ("assistant", ""), ("system", "c")]
    cost, audit, _ = brute(rows)
    assert searched(rows) == (cost, audit) and kept in audit
