"""Conversation structure repair by depth-first branch-and-bound.

A conversation is sound if its role initials read ``(s?(ua)+)?``: perhaps a
system turn, then user and assistant in turn, none left open. A repair keeps,
reroles, deletes or inserts turns; the cheapest wins, and among those of equal
cost the one whose audit (the edits' initials in order) is least in ASCII.

Rows are sorted once over the whole cluster and numbered. A conversation is cut
into segments of bounded length, whatever its own length. The search runs on a
segment for every state of the pattern that it can start and end in; the results
of a conversation's segments are then chained. That is exact: audits of equal cost
over the same rows are never one the beginning of the other (the longer one
would hold more inserted turns and cost more), so the better beginning of two that
end in the same state stays the better one, whatever follows.
"""
from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from jobsift.llm.common import stored

#: Characters that do not count as text.
BLANKS = " \t\n\x0b\f\r"
#: log2 of the most rows of a segment.
SEGMENT_BITS = 10
#: Characters of a text that order rows of one turn and role; after them its SHA-256 does.
ORDER_CHARS = 256
#: Patterns of segments whose results a task remembers.
REMEMBERED = 20_000

# FIXED VALUES: what the edits cost.
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1

# States of the pattern: nothing yet, system turn, user turn (open), assistant turn.
START, SYSTEM, OPEN, CLOSED = range(4)
STATES = (START, SYSTEM, OPEN, CLOSED)
SOUND = (START, CLOSED)
STEP = {(START, "s"): SYSTEM, (START, "u"): OPEN, (SYSTEM, "u"): OPEN, (OPEN, "a"): CLOSED, (CLOSED, "u"): OPEN}
#: Where a turn leads whose role may be chosen: to the other side.
CHOSEN = {START: OPEN, SYSTEM: OPEN, OPEN: CLOSED, CLOSED: OPEN}
ROLE_OF = {OPEN: "user", CLOSED: "assistant"}
LEGAL_PAIRS = frozenset(("su", "ua", "au"))
NEVER = 1 << 60


@dataclass
class Repair:
    """conversations: one row each (see ``repair``); rows: the damaged rows, numbered; decided: a segment's audit."""
    conversations: DataFrame
    rows: DataFrame
    decided: DataFrame


def row_code(initial: str, must_delete: bool, truncated: bool) -> str:
    """One character for all that the search needs to know of a row."""
    kind = "sua".find(initial) if initial else 4
    return chr(65 + (3 if kind < 0 else kind) * 4 + 2 * must_delete + truncated)


def _decode(code: str) -> tuple[str, bool, bool]:
    kind, flags = divmod(ord(code) - 65, 4)
    return ("s", "u", "a", "?", "")[kind], bool(flags & 2), bool(flags & 1)


def _edits(state: int, row: tuple[str, bool, bool] | None):
    """(letter, cost, next state, rows used) in ASCII order of the letters; no row is left at the end."""
    if row is not None:
        yield "D", DELETE_COST, state, 1
    yield "I", INSERT_COST, CHOSEN[state], 0
    if row is not None and not row[1]:
        initial, _, truncated = row
        kept = state if not initial else STEP.get((state, initial))
        if kept is not None:
            yield "K", TRUNCATED_COST * truncated, kept, 1
        yield "R", REROLE_COST + TRUNCATED_COST * truncated, CHOSEN[state], 1


def suffix_bounds(rows: list[tuple[str, bool, bool]], end: int) -> list[list[int]]:
    """[row][state]: no repair of the rows from here on that ends in ``end`` costs less."""
    def with_inserts(base: list[int]) -> list[int]:
        out = []
        for s in STATES:                        # more than two inserted turns in a row lead back to where one did
            one = CHOSEN[s]
            out.append(min(base[s], INSERT_COST + base[one], 2 * INSERT_COST + base[CHOSEN[one]]))
        return out

    bounds = [with_inserts([0 if s == end else NEVER for s in STATES])]
    for row in reversed(rows):
        after = bounds[-1]
        bounds.append(with_inserts([min(c + after[t] for _, c, t, used in _edits(s, row) if used) for s in STATES]))
    return bounds[::-1]


def branch_and_bound(rows: list[tuple[str, bool, bool]], start: int, end: int) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits that lead from state ``start`` to ``end``, ties to the least audit.

    Depth first with an explicit stack, the most promising edit on top. A branch is
    left when its bound exceeds the incumbent, when it ties with it but its audit is
    already greater, or when its row and state were reached before by a better
    (cost, audit). The empty stack proves the incumbent.
    """
    bounds, n = suffix_bounds(rows, end), len(rows)
    if bounds[0][start] >= NEVER:
        return None
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        bound = cost + bounds[at][state]
        if best is not None and (bound > best[0] or bound == best[0] and audit > best[1][:len(audit)]):
            continue
        known = reached.get((at, state))
        if known is not None and known <= (cost, audit):
            continue
        reached[at, state] = (cost, audit)
        if at == n and state == end and (best is None or (cost, audit) < best):
            best = (cost, audit)
        branches = [(cost + c + bounds[at + used][t], letter, at + used, t, cost + c)
                    for letter, c, t, used in _edits(state, rows[at] if at < n else None) if bounds[at + used][t] < NEVER]
        branches.sort(reverse=True)
        stack += [(j, t, c, audit + letter) for _, letter, j, t, c in branches]
    return best


@lru_cache(maxsize=REMEMBERED)
def _solve_known(codes: str) -> tuple:
    return _solve(codes)


def _solve(codes: str) -> tuple:
    rows = [_decode(c) for c in codes]
    found = []
    for start in STATES:
        for end in STATES:
            best = branch_and_bound(rows, start, end)
            if best is not None:
                found.append((start, end, *best))
    return tuple(found)


def solve_segment(codes: str) -> tuple:
    """(start, end, cost, audit) for all pairs of states between which the segment's rows can be repaired."""
    return _solve_known(codes) if len(codes) <= 64 else _solve(codes)


def chain(before: dict[int, tuple], segment) -> dict[int, tuple]:
    """The best way to each state after one more segment. A way: (cost, parts), parts linked from the last back."""
    out: dict[int, tuple] = {}
    for start, end, cost, audit in segment:
        if start in before:
            way = (before[start][0] + cost, (before[start][1], start, audit))
            if end not in out or _less(way, out[end]):
                out[end] = way
    return out


def parts_of(way: tuple) -> list[tuple[int, str]]:
    """(state before, audit) of each segment, first to last."""
    out, link = [], way[1]
    while link is not None:
        link, start, audit = link
        out.append((start, audit))
    return out[::-1]


def _less(a: tuple, b: tuple) -> bool:
    if a[0] != b[0]:
        return a[0] < b[0]
    return "".join(x for _, x in parts_of(a)) < "".join(x for _, x in parts_of(b))


def edit_rows(audit: str, state: int, rows):
    """(action, role, text) of a segment's edits in order, deleted rows included; ``rows`` yields (role, text)."""
    for letter in audit:
        if letter == "I":
            state = CHOSEN[state]
            yield "insert", ROLE_OF[state], ""
            continue
        role, text = next(rows)
        if letter == "D":
            yield "delete", role, text
        elif letter == "R":
            state = CHOSEN[state]
            yield "rerole", ROLE_OF[state], text
        else:
            state = STEP[state, role[:1]] if role else state
            yield "keep", role, text


# ---- DataFrame side -------------------------------------------------------------------------------------------

def _or_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with planted faults, by crc32(``conv_id:turn``) modulo 20.

    0 drops the row, 1 empties its text, 2 removes ``. ! ?`` from it, 3 repeats
    the row, 4 makes its role user. Nulls read as one space, but turn stays null.
    """
    code = F.crc32(F.concat(_or_space(conv), F.lit(":"), _or_space(turn)).cast("binary")) % 20
    body = _or_space(text)
    return (rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), code.alias("_code"),
                        F.when(code == 4, "user").otherwise(_or_space(role)).alias("role"),
                        F.when(code == 1, "").when(code == 2, F.translate(body, ".!?", "")).otherwise(body).alias("text"))
            .where("_code <> 0")
            .withColumn("_copy", F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("_code", "_copy"))


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with their number ``n`` in the order of conversation and turn, stored.

    Turns come nulls first; within one, rows are ordered by role, then by their
    text's first ORDER_CHARS characters, then by its SHA-256. Equal rows may be in
    any order, so a number made per row lets the sort spread even one row that a
    third of the table repeats.
    """
    keys = ["conv_id", "turn", "role", "_head", "_sha", "_salt"]
    marked = (rows.withColumn("_head", F.substring("text", 1, ORDER_CHARS)).withColumn("_sha", F.sha2(F.col("text").cast("binary"), 256))
              .withColumn("_salt", F.monotonically_increasing_id()))
    ordered = marked.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(ordered.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("n")), "conv-rows")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, n, initial, fault) of numbered rows; fault: blank, duplicate, truncated or null."""
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    flags = rows.select("conv_id", "turn", "n", F.substring("role", 1, 1).alias("initial"), (body == "").alias("blank"),
                        (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("open_end"))
    # The first of equal rows, found by a grouped minimum and joined by row number: no key of that join is hot.
    same = rows.select("conv_id", "role", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "n")
    first = same.groupBy("conv_id", "role", "sha").agg(F.min("n").alias("n")).select("n", F.lit(True).alias("first"))
    return flags.join(first, "n", "left").select(
        "conv_id", "turn", "n", "initial",
        F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("open_end"), "truncated").alias("fault"))


def _runs(batches, key: list[str]):
    """(key, rows) of runs of equal keys in sorted batches, rows one by one; only one row is held."""
    rows = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))))
    width = len(key)
    return itertools.groupby(rows, lambda r: r[:width])


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _in_batches(rows, schema: pa.Schema, most: int = 2000, most_chars: int = 8 << 20):
    """Record batches of at most ``most`` rows; long strings end a batch early."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= most or chars >= most_chars:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _stream(df: DataFrame, make_rows, columns: str, most: int = 2000) -> DataFrame:
    """``df``'s sorted batches through ``make_rows(batches)``, which yields rows whose first entry is a conversation id
    of df's type and whose others are ``columns`` (DDL)."""
    others = to_arrow_schema(StructType.fromDDL(columns))

    def run(batches):
        first = next(batches, None)
        if first is not None:
            schema = pa.schema([pa.field("conv_id", first.schema.field(0).type), *others])
            yield from _in_batches(make_rows(itertools.chain([first], batches)), schema, most)
    return df.mapInArrow(run, f"conv_id {df.schema['conv_id'].dataType.simpleString()}, {columns}")


def search(checked: DataFrame, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """(conv_id, seg, first, last, illegal, ways): each segment's best edits for all pairs of states."""
    def solve(batches):
        for (conv_id, seg), rows in _runs(batches, ["conv_id", "seg"]):
            codes, last, first, illegal = [], None, None, 0
            for _, _, _, initial, fault in rows:
                codes.append(row_code(initial, fault in ("blank", "duplicate"), fault == "truncated"))
                if last is None:
                    first = initial
                else:
                    illegal += last + initial not in LEGAL_PAIRS
                last = initial
            ways = [dict(zip(("start", "end", "cost", "audit"), w)) for w in solve_segment("".join(codes))]
            yield conv_id, seg, first, last, illegal, ways

    cut = checked.select("conv_id", F.shiftright("n", segment_bits).alias("seg"), "n", "initial", "fault")
    return _stream(cut.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "n"), solve,
                   "seg long, first string, last string, illegal long, ways array<struct<start:int,end:int,cost:long,audit:string>>", 500)


def decide(searched: DataFrame) -> DataFrame:
    """The chosen edits: a row a segment (conv_id, seg, start, audit), and a row a conversation, whose seg is null, with
    its cost, its whole audit and the illegal pairs, those across segments included.

    A task streams segments; of a conversation it holds at most four audits, and a result row holds one.
    """
    def combine(batches):
        for (conv_id,), segments in _runs(batches, ["conv_id"]):
            ways, segs, last, illegal = {START: (0, None)}, [], None, 0
            for _, seg, head, tail, wrong, found in segments:
                illegal += wrong + (last is not None and last + head not in LEGAL_PAIRS)
                ways, last = chain(ways, [(w["start"], w["end"], w["cost"], w["audit"]) for w in found]), tail
                segs.append(seg)
            best = None
            for s in SOUND:
                if s in ways and (best is None or _less(ways[s], best)):
                    best = ways[s]
            parts = parts_of(best)
            for seg, (start, audit) in zip(segs, parts):
                yield conv_id, seg, start, audit, None, None
            yield conv_id, None, None, "".join(a for _, a in parts), best[0], illegal

    return _stream(searched.repartition("conv_id").sortWithinPartitions("conv_id", "seg"), combine,
                   "seg long, start int, audit string, cost long, illegal long")


def repair(rows: DataFrame, segment_bits: int = SEGMENT_BITS) -> Repair:
    """Repair conversations given as rows (conv_id, turn, role, text); other columns are left out.

    ``conversations`` has (conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit). A row's first fault counts: blank (no character but white space),
    duplicate (role and text seen earlier), truncated (the last such character is
    none of ``. ! ?``). gaps: turns missing between the least and the greatest (null
    turns ignored; none: 0); illegal: neighbours whose role initials are not su, ua or
    au. Blank and duplicate rows have to be deleted; truncated ones cost 1 if they
    stay. Role, text: null reads as empty. A row with an empty role has no initial and
    may stay anywhere. Null conversation ids form one conversation, null turns come
    first, equal rows count as often as they stand there. No rows: no conversations.
    """
    rows = in_order(rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    checked = stored(faults(rows), "conv-faults")
    decided = stored(decide(search(checked, segment_bits)), "conv-decided")
    count = [F.sum((F.col("fault") == f).cast("long")).alias(f) for f in ("blank", "duplicate", "truncated")]
    by_turn = checked.groupBy("conv_id", "turn").agg(*[F.coalesce(c, F.lit(0)).alias(f) for c, f in zip(count, ("blank", "duplicate", "truncated"))])
    gaps = F.max("turn").cast("long") - F.min("turn").cast("long") + 1 - F.count("turn")
    counts = by_turn.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0).cast("long")).alias("gaps"),
                                            *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    whole = decided.where("seg IS NULL").select(F.col("conv_id").alias("_conv"), "illegal", "cost", "audit")
    report = counts.join(whole, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    segs = decided.where("seg IS NOT NULL").select("conv_id", "seg", "start", "audit")
    return Repair(report, rows.withColumn("seg", F.shiftright("n", segment_bits)), segs)


def _with_decisions(done: Repair) -> DataFrame:
    """Rows and, before each segment's, a row (n = -1) with its start state and audit in the place of role and text."""
    conv = F.col("conv_id")
    return (done.decided.select(conv, "seg", F.lit(-1).cast("long").alias("n"), F.col("start").cast("string").alias("role"), F.col("audit").alias("text"))
            .unionByName(done.rows.select(conv, "seg", "n", "role", "text")))


def _edited(batches):
    """((conv_id, seg), edits) by segment of sorted ``_with_decisions`` rows."""
    for key, rows in _runs(batches, ["conv_id", "seg"]):
        _, _, _, start, audit = next(rows)
        yield key, edit_rows(audit, int(start), ((r[3], r[4]) for r in rows))


def repaired_rows(done: Repair) -> DataFrame:
    """(conv_id, seg, position, action, role, text): every edit; rows with action delete are not part of the result.
    (seg, position) order a conversation. No task holds more than a segment's row at a time."""
    def apply(batches):
        for (conv_id, seg), edits in _edited(batches):
            for position, edit in enumerate(edits):
                yield conv_id, seg, position, *edit

    return _stream(_with_decisions(done).repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "n"), apply,
                   "seg long, position int, action string, role string, text string")


def repaired_digest(done: Repair) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of the repaired conversation's ``role:text``, joined by newlines.

    A digest has to read its conversation in order, so this step alone streams a
    conversation through one task; it holds one row at a time.
    """
    def digest(batches):
        for conv_id, segments in itertools.groupby(_edited(batches), lambda s: s[0][0]):
            sha, some = hashlib.sha256(), False
            for _, edits in segments:
                for action, role, text in edits:
                    if action != "delete":
                        sha.update((("\n" if some else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
                        some = True
            yield conv_id, sha.hexdigest()

    return _stream(_with_decisions(done).repartition("conv_id").sortWithinPartitions("conv_id", "seg", "n"), digest,
                   "repaired_sha256 string")


def repair_report(original: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """Damage ``original``, repair it, and report every original conversation (see ``damage`` and ``repair``).

    A conversation without rows after damage has zeros, an empty audit and the digest of nothing.
    """
    done = repair(damage(original, conv, turn, role, text), segment_bits)
    same = lambda name: F.col("conv_id").eqNullSafe(F.col(name))
    ids = original.select(F.col(conv).alias("conv_id")).distinct()
    out = (ids.join(done.conversations.withColumnRenamed("conv_id", "_a"), same("_a"), "left")
           .join(repaired_digest(done).withColumnRenamed("conv_id", "_b"), same("_b"), "left"))
    longs = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
