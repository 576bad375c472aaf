"""Secret scan with one combined deterministic automaton for all rules.

All rule expressions are compiled into one minimal automaton (``automaton``), and
one pass over the bytes of a block of texts gives the state after every byte. A
stretch in which some rule accepted, between two bytes that lead back to the
start, is then cut into leftmost, longest, non-overlapping matches of that rule: a
backward pass of the rule's reversed automaton tells where matches begin, and only
there the forward one is run. So no byte is read from a start that leads nowhere; the time is
linear for rules whose matches stay matches as they grow, which all of RULES are.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.automaton import Scanner, compile_rules, longest_match, match_starts
from jobsift.llm.common import bounded_batches, text_bytes

#: Bytes of texts that are scanned at a time.
BLOCK_BYTES = 4_000_000


@dataclass(frozen=True)
class Rule:
    """``least`` is the shortest match, or the shortest value of an assignment, that is kept."""
    kind: str
    pattern: str
    least: int = 0
    value_only: bool = False


# FIXED VALUES: the base kinds, then common public key formats.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)
BASE_KINDS = ("assign", "access", "hex")


def _value_length(match: bytes) -> int:
    """Length of an assignment's value: what follows the first : or =, spaces and one quote."""
    cut = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    rest = match[cut + 1:].lstrip(b" ")
    return len(rest) - (rest[:1] in (b'"', b"'"))


class SecretScanner:
    def __init__(self, rules=RULES):
        self.rules = rules
        self.scanner = Scanner(compile_rules([r.pattern for r in rules], anywhere=True))
        if not self.scanner.resets[0]:
            raise ValueError("no rule may use the zero byte")
        self.single = []
        for r in rules:
            a = compile_rules([r.pattern], anywhere=False)
            rows = a.table.reshape(-1, 256)
            dead = [s for s in range(a.states) if not a.accepts[s] and (rows[s] == s * 256).all()]
            back = compile_rules([r.pattern], anywhere=True, backwards=True)
            self.single.append((a.table.tolist(), a.accepts.tolist(), dead[0] * 256 if dead else -1, back.table.tolist(), back.accepts.tolist()))

    def _cut(self, rule: int, data: bytes):
        """Leftmost, longest, non-overlapping matches of one rule, those that are too short left out."""
        table, accepts, dead, back, begins = self.single[rule]
        r, behind = self.rules[rule], 0
        for at in match_starts(back, begins, data):
            if at < behind:
                continue
            behind = longest_match(table, accepts, dead, data, at)
            size = _value_length(data[at:behind]) if r.value_only else behind - at
            if size >= r.least:
                yield at, behind

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text its (start, rule, end), in code points, by start, then rule."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        joined = b"\0".join(texts) + b"\0"
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        data = np.frombuffer(joined, np.uint8)
        states = self.scanner.states(data) >> 8
        hits = np.flatnonzero(self.scanner.auto.accepts[states])
        if not len(hits):
            return out
        quiet = np.flatnonzero(states == 0)
        stretch = np.searchsorted(quiet, hits)
        rules = self.scanner.auto.accepts[states[hits]]
        seen = {}
        for s, r in zip(stretch.tolist(), rules.tolist()):
            seen[s] = seen.get(s, 0) | r
        for s, accepted in seen.items():
            begin, end = int(quiet[s - 1]) + 1 if s else 0, int(quiet[s])
            doc = int(np.searchsorted(begins, begin, side="right")) - 1
            for rule in range(len(self.rules)):
                if accepted >> rule & 1:
                    for a, b in self._cut(rule, joined[begin:end]):
                        out[doc].append((begin + a - int(begins[doc]), rule, begin + b - int(begins[doc])))
        for doc, spans in enumerate(out):
            spans.sort()
            if spans and not texts[doc].isascii():              # byte offsets to code points
                points = np.cumsum((np.frombuffer(texts[doc], np.uint8) & 0xC0) != 0x80)
                spans[:] = [(int(points[a - 1]) if a else 0, r, int(points[b - 1])) for a, r, b in spans]
        return out


_SCANNERS: dict[tuple, SecretScanner] = {}


def scanner(rules=RULES) -> SecretScanner:
    """One scanner per Python worker and rule set."""
    if rules not in _SCANNERS:
        _SCANNERS[rules] = SecretScanner(rules)
    return _SCANNERS[rules]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per row of ``docs``: id, found (array of kind, start, end in code points, by start, then rule order).

    A null or empty text has no spans. Null and repeated ids keep their rows; an
    empty table gives no rows; other columns are not read. A match that is too
    short is dropped and the scan goes on behind it.
    """
    kinds = [r.kind for r in rules]

    def run(batches):
        scan = scanner(rules).scan
        for b in batches:
            texts = b.column("__bytes").to_pylist()
            found, block, size = [], [], 0
            for t in texts:
                block.append(t)
                size += len(t)
                if size >= BLOCK_BYTES:
                    found += scan(block)
                    block, size = [], 0
            found += scan(block) if block else []
            spans = [[{"kind": kinds[r], "start": a, "end": e} for a, r, e in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array(spans, pa.list_(pa.struct(
                [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], names=["__id", "found"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = bounded_batches(docs).select(F.col(id_col).alias("__id"), text_bytes(text_col).alias("__bytes")).mapInArrow(
        run, f"__id {kind}, found array<struct<kind:string,start:long,end:long>>")
    return out.select(F.col("__id").alias(id_col), "found")


def span_text(spans):
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, base_kinds=BASE_KINDS) -> list:
    """Columns n_<kind>, base_sha256 and spans from ``found``."""
    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in base_kinds]
    base = F.filter("found", lambda s: s["kind"].isin(*base_kinds))
    return [*counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans")]
