"""Byte automata: rule expressions to one minimal deterministic automaton in transition arrays.

The expressions use literals, escapes (\\., \\xHH), classes, groups, alternation, the
repeats ? * + {m} {m,} {m,n}, and (?i:...) for ASCII letters in either case.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

_REPEAT = re.compile(r"\{(\d+)(,(\d*))?\}")


class _Nfa:
    """Epsilon automaton by Thompson's construction: per state its epsilon targets and (byte set, target) edges."""

    def __init__(self):
        self.eps: list[list[int]] = []
        self.edges: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.eps.append([])
        self.edges.append([])
        return len(self.eps) - 1

    def turn(self) -> None:
        """Every edge the other way round."""
        eps, edges = [[] for _ in self.eps], [[] for _ in self.edges]
        for s, (to, by) in enumerate(zip(self.eps, self.edges)):
            for t in to:
                eps[t].append(s)
            for chars, t in by:
                edges[t].append((chars, s))
        self.eps, self.edges = eps, edges

    def parse(self, text: str) -> tuple[int, int]:
        self.text, self.at, self.fold = text, 0, False
        out = self._choice()
        if self.at != len(text):
            raise ValueError(f"unexpected {text[self.at]!r} in {text!r}")
        return out

    def _peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def _choice(self):
        first = self._sequence()
        if self._peek() != "|":
            return first
        start, end = self.state(), self.state()
        options = [first]
        while self._peek() == "|":
            self.at += 1
            options.append(self._sequence())
        for a, b in options:
            self.eps[start].append(a)
            self.eps[b].append(end)
        return start, end

    def _sequence(self):
        start = end = self.state()
        while self._peek() not in ("", "|", ")"):
            begin = self.at
            a, b = self._atom()
            low, high = self._count()
            if (low, high) != (1, 1):
                a, b = self._repeated(begin, low, high)
            self.eps[end].append(a)
            end = b
        return start, end

    def _count(self):
        c = self._peek()
        simple = {"?": (0, 1), "*": (0, None), "+": (1, None)}
        if c in simple:
            self.at += 1
            return simple[c]
        m = _REPEAT.match(self.text, self.at)
        if not m:
            return 1, 1
        self.at = m.end()
        low = int(m[1])
        return low, low if m[2] is None else int(m[3]) if m[3] else None

    def _repeated(self, begin: int, low: int, high: int | None):
        """Copies of the atom at ``begin``: ``low`` in a row, then optional ones or a loop."""
        after, start = self.at, self.state()
        end = start
        exits = [start] if low == 0 else []
        copies = high if high is not None else max(low, 1)
        for i in range(copies):
            self.at = begin
            a, b = self._atom()
            self.eps[end].append(a)
            end = b
            if i + 1 >= low:
                exits.append(end)
        if high is None:
            self.eps[end].append(a)
        out = self.state()
        for x in exits:
            self.eps[x].append(out)
        self.at = after
        return start, out

    def _atom(self):
        c = self._peek()
        if c == "(":
            fold = self.fold
            if self.text.startswith("(?i:", self.at):
                self.at, self.fold = self.at + 4, True
            else:
                self.at += 3 if self.text.startswith("(?:", self.at) else 1
            out = self._choice()
            if self._peek() != ")":
                raise ValueError(f"missing ) in {self.text!r}")
            self.at, self.fold = self.at + 1, fold
            return out
        chars = self._class() if c == "[" else {self._char()}
        if self.fold:
            chars = {y for x in chars for y in chr(x).swapcase().encode("latin-1")} | chars
        a, b = self.state(), self.state()
        self.edges[a].append((frozenset(chars), b))
        return a, b

    def _char(self) -> int:
        c = self._peek()
        self.at += 1
        if c == "\\":
            c = self._peek()
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2:self.at], 16)
            return {"t": 9, "n": 10, "r": 13}.get(c, ord(c))
        return ord(c)

    def _class(self) -> set[int]:
        self.at += 1
        negated = self._peek() == "^"
        self.at += negated
        out: set[int] = set()
        while self._peek() != "]":
            low = high = self._char()
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                high = self._char()
            out |= set(range(low, high + 1))
        self.at += 1
        return set(range(256)) - out if negated else out


@dataclass
class Automaton:
    """table[state * 256 + byte] is the next state times 256; accepts[state] has bit r set if rule r ends here. State 0 is the start."""
    table: np.ndarray
    accepts: np.ndarray

    @property
    def states(self) -> int:
        return len(self.accepts)


def compile_rules(patterns: list[str], anywhere: bool, backwards: bool = False) -> Automaton:
    """One minimal automaton for all rules, which may begin at any byte (``anywhere``) or only at the first.

    An anchored automaton has a dead state, from which nothing can match any more.
    One that is ``backwards`` reads text from its end: where it accepts, a match begins.
    """
    nfa = _Nfa()
    ends: dict[int, int] = {}
    start = nfa.state()
    parsed = [nfa.parse(p) for p in patterns]
    if backwards:
        parsed = [(b, a) for a, b in parsed]
        nfa.turn()
    for r, (a, b) in enumerate(parsed):
        nfa.eps[start].append(a)
        ends[b] = r

    def closure(states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in nfa.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    initial = closure([start])
    number, order, rows = {initial: 0}, [initial], []
    for here in order:                                          # grows while subsets are found
        targets: list[set[int]] = [set() for _ in range(256)]
        for s in here:
            for chars, t in nfa.edges[s]:
                for c in chars:
                    targets[c].add(t)
        known: dict[frozenset, int] = {}
        row = []
        for t in targets:
            k = frozenset(t)
            if k not in known:
                nxt = closure(k) | (initial if anywhere else frozenset())
                if nxt not in number:
                    number[nxt] = len(order)
                    order.append(nxt)
                known[k] = number[nxt]
            row.append(known[k])
        rows.append(row)
    accepts = np.array([sum(1 << r for s, r in ends.items() if s in here) for here in order], np.int64)
    return _minimal(np.array(rows, np.int64), accepts)


def _minimal(table: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Moore's refinement: states stay together while they accept alike and their targets stay together."""
    group = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    # the start's group becomes state 0
    new = np.arange(group.max() + 1)
    new[[0, group[0]]] = new[[group[0], 0]]
    group = new[group]
    first = np.unique(group, return_index=True)[1]
    return Automaton((group[table[first]] * 256).astype(np.int32).ravel(), accepts[first])


class Scanner:
    """Runs an ``anywhere`` automaton over bytes, many lanes in step, and gives the state after every byte.

    Lanes are cut behind bytes that lead back to the start from every state, so
    each lane begins in a known state and no match crosses a cut.
    """

    def __init__(self, auto: Automaton, lanes: int = 8192):
        self.auto, self.lanes = auto, lanes
        self.resets = (auto.table.reshape(-1, 256) == 0).all(axis=0)
        self.slow_table = auto.table.tolist()

    def states(self, data: np.ndarray) -> np.ndarray:
        """The state times 256 after each byte; the bytes must begin at a known start."""
        out = np.zeros(len(data), np.int32)
        if not len(data):
            return out
        cuts = np.flatnonzero(self.resets[data]) + 1
        wanted = np.linspace(0, len(data), min(self.lanes, -(-len(data) // 64)) + 1)[1:-1]
        at = np.searchsorted(cuts, wanted)
        starts = np.unique(np.concatenate([[0], cuts[at[at < len(cuts)]]]))
        starts = starts[starts < len(data)]
        lengths = np.diff(np.append(starts, len(data)))
        by_length = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[by_length], lengths[by_length]
        state, table = np.zeros(len(starts), np.int32), self.auto.table
        active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
        for step, a in enumerate(active.tolist()):
            if a < 8:                                           # a few long lanes: byte by byte
                for i in range(a):
                    s, begin, end = int(state[i]), int(starts[i]) + step, int(starts[i] + lengths[i])
                    seen = []
                    for c in data[begin:end].tolist():
                        s = self.slow_table[s + c]
                        seen.append(s)
                    out[begin:end] = seen
                break
            where = starts[:a] + step
            now = table[state[:a] + data[where]]
            state[:a] = now
            out[where] = now
        return out


def longest_match(table: list[int], accepts: list[int], dead: int, data: bytes, at: int) -> int:
    """End of the longest match of an anchored automaton that begins at ``at``, or -1."""
    s, end = 0, -1
    for i in range(at, len(data)):
        s = table[s + data[i]]
        if s == dead:
            break
        if accepts[s >> 8]:
            end = i + 1
    return end


def match_starts(table: list[int], accepts: list[int], data: bytes) -> list[int]:
    """Where matches begin, ascending, by one pass of a ``backwards``, ``anywhere`` automaton from the end."""
    s, out = 0, []
    for i in range(len(data) - 1, -1, -1):
        s = table[s + data[i]]
        if accepts[s >> 8]:
            out.append(i)
    return out[::-1]
