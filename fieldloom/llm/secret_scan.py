"""Secret scans with one combined deterministic automaton (operator 6).

Rules are regexes over bytes. They are parsed, reversed, made into one unanchored NFA, determinised by subset
construction and minimised; the result is an array of transitions. A text is read once, byte by byte from its end,
for all rules together: whenever the automaton enters an accepting state, some match of the accepted rules starts there.
A rule's first start behind its last span gives the next one, which its forward automaton follows to the longest
end; for these rules that is the leftmost greedy match. States from which a walk found no further end are remembered
with their positions, so that no walk repeats another's and the whole scan takes time in proportion to the text.
Reading from the end keeps the automaton small (hundreds of states instead of thousands), because the rules differ more
in how they begin than in how they end.
"""

from __future__ import annotations

import functools
import hashlib
import operator
import pickle
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame

from fieldloom.llm.common import Shared, map_texts

# --- rules -------------------------------------------------------------------------------------------------


def _long_value(match: bytes) -> bool:
    """Whether what follows the separator, blanks and a quote has 12 bytes or more."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0) + 1
    while match[at : at + 1] == b" ":
        at += 1
    if match[at : at + 1] in (b'"', b"'"):
        at += 1
    return len(match) - at >= 12


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    keep: Callable[[bytes], bool] = field(default=lambda m: True)
    fold: bool = False


def _at_least(n: int) -> Callable[[bytes], bool]:
    return lambda m: len(m) >= n


#: The three base rules, in their order, then those that the scan adds. A run of hex digits is matched from 16 on:
#: as runs are maximal, that equals matching any run and dropping the shorter ones.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", _long_value, True),
    Rule("access", r"AKIA[A-Z0-9]+", _at_least(18)),
    Rule("hex", r"[0-9a-f]{16,}", _at_least(16)),
    Rule("private_key", r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", _at_least(36)),
    Rule("slack", r"xox[abprs]-[0-9][A-Za-z0-9-]+", _at_least(20)),
    Rule("google", r"AIza[0-9A-Za-z_-]+", _at_least(39)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", _at_least(40)),
)
BASE = ("assign", "access", "hex")

# --- regexes to automata -----------------------------------------------------------------------------------


class _Parser:
    """Literals, escapes, classes, groups, alternatives and the quantifiers ? * + {m,n}; nothing else."""

    def __init__(self, text: str, fold: bool):
        self.s, self.i, self.fold = text, 0, fold

    def whole(self):
        node = self.either()
        if self.i != len(self.s):
            raise ValueError(f"can't parse {self.s!r} at {self.i}")
        return node

    def peek(self) -> str:
        return self.s[self.i : self.i + 1]

    def either(self):
        arms = [self.chain()]
        while self.peek() == "|":
            self.i += 1
            arms.append(self.chain())
        return arms[0] if len(arms) == 1 else ("or", arms)

    def chain(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("seq", parts)

    def repeated(self):
        node = self.atom()
        while (c := self.peek()) and c in "?*+{":
            self.i += 1
            if c == "{":
                end = self.s.index("}", self.i)
                low, comma, high = self.s[self.i : end].partition(",")
                self.i = end + 1
                lo, hi = int(low), (int(high) if high else None) if comma else int(low)
            else:
                lo, hi = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            node = ("rep", node, lo, hi)
        return node

    def atom(self):
        c = self.peek()
        self.i += 1
        if c == "(":
            if self.s.startswith("?:", self.i):
                self.i += 2
            node = self.either()
            self.i += 1
            return node
        if c == "[":
            return ("set", self.folded(self.bracket()))
        if c == "\\":
            return ("set", self.folded({self.escape()}))
        return ("set", self.folded({ord(c)}))

    def escape(self) -> int:
        c = self.s[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.s[self.i - 2 : self.i], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def bracket(self) -> set[int]:
        negated = self.peek() == "^"
        self.i += negated
        out: set[int] = set()
        while self.peek() != "]":
            lo = self.member()
            hi = lo
            if self.peek() == "-" and self.s[self.i + 1] != "]":
                self.i += 1
                hi = self.member()
            out.update(range(lo, hi + 1))
        self.i += 1
        return set(range(256)) - out if negated else out

    def member(self) -> int:
        c = self.s[self.i]
        self.i += 1
        return self.escape() if c == "\\" else ord(c)

    def folded(self, found: set[int]) -> frozenset[int]:
        if self.fold:
            letters = {b for b in found if chr(b).isascii() and chr(b).isalpha()}
            found = found | {ord(chr(b).swapcase()) for b in letters}
        return frozenset(found)


def _reversed(node):
    kind = node[0]
    if kind == "seq":
        return ("seq", [_reversed(x) for x in reversed(node[1])])
    if kind == "or":
        return ("or", [_reversed(x) for x in node[1]])
    if kind == "rep":
        return ("rep", _reversed(node[1]), *node[2:])
    return node


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.arcs: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.arcs.append([])
        return len(self.arcs) - 1

    def add(self, node, a: int) -> int:
        """Append the node's automaton after state ``a``; its end."""
        kind = node[0]
        if kind == "set":
            b = self.state()
            self.arcs[a].append((node[1], b))
            return b
        if kind == "seq":
            for x in node[1]:
                a = self.add(x, a)
            return a
        if kind == "or":
            end = self.state()
            for x in node[1]:
                s = self.state()
                self.empty[a].append(s)
                self.empty[self.add(x, s)].append(end)
            return end
        _, inner, lo, hi = node
        for _ in range(lo):
            a = self.add(inner, a)
        end = self.state()
        if hi is None:
            loop = self.state()
            self.empty[a].append(loop)
            self.empty[self.add(inner, loop)].append(loop)
            self.empty[loop].append(end)
        else:
            self.empty[a].append(end)
            for _ in range(hi - lo):
                a = self.add(inner, a)
                self.empty[a].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


@dataclass
class Dfa:
    """``step[state, byte]``, the rules that each state accepts as bits, and the first state. State 0 of an anchored automaton may be dead."""

    step: np.ndarray
    accepts: np.ndarray
    start: int
    dead: int


def compile_dfa(nodes: list, unanchored: bool) -> Dfa:
    nfa = _Nfa()
    root, ends = nfa.state(), {}
    for k, node in enumerate(nodes):
        s = nfa.state()
        nfa.empty[root].append(s)
        ends[nfa.add(node, s)] = 1 << k
    edges = {b for out in nfa.arcs for s, _ in out for b in (*s, *(x + 1 for x in s))}
    bound = sorted({0, *(e for e in edges if e < 256)})
    sets = [s for out in nfa.arcs for s, _ in out]
    groups: dict[tuple, int] = {}
    of_byte = np.zeros(256, np.int64)
    for i, lo in enumerate(bound):
        hi = bound[i + 1] if i + 1 < len(bound) else 256
        of_byte[lo:hi] = groups.setdefault(tuple(lo in s for s in sets), len(groups))
    sample = [int(np.flatnonzero(of_byte == g)[0]) for g in range(len(groups))]
    first = nfa.closure({root})
    ids, order, rows = {first: 0}, [first], []
    for now in order:  # subset construction; the list grows while it is read
        row = []
        arcs = [(s, t) for q in now for s, t in nfa.arcs[q]]
        for b in sample:
            to = {t for s, t in arcs if b in s}
            nxt = nfa.closure(to | {root} if unanchored else to)
            if nxt not in ids:
                ids[nxt] = len(order)
                order.append(nxt)
            row.append(ids[nxt])
        rows.append(row)
    step = np.array(rows)
    accepts = np.array([sum(ends.get(q, 0) for q in s) for s in order])
    block = np.unique(accepts, return_inverse=True)[1].ravel()
    while True:  # minimisation: states stay together while all their successors do
        _, new = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)
        new = new.ravel()
        if new.max() == block.max():
            break
        block = new
    n = int(block.max()) + 1
    one = np.zeros(n, np.int64)
    one[block] = np.arange(len(block))
    small = block[step[one]]
    dead = next((q for q in range(n) if not accepts[one[q]] and (small[q] == q).all()), -1)
    return Dfa(small[:, of_byte].astype(np.int32), accepts[one], int(block[0]), -1 if unanchored else dead)


@dataclass
class Compiled:
    """One automaton over reversed texts for all rules together, and an anchored forward one for each."""

    combined: Dfa
    forward: list[Dfa]


@functools.cache
def compile_rules(rules: tuple[Rule, ...] = RULES) -> Compiled:
    trees = [_Parser(r.pattern, r.fold).whole() for r in rules]
    return Compiled(compile_dfa([_reversed(t) for t in trees], True), [compile_dfa([t], False) for t in trees])


# --- scanning ----------------------------------------------------------------------------------------------


class Scanner:
    """Scans whole texts; made once per Python worker from the compiled arrays."""

    def __init__(self, compiled: Compiled, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.forward = [(d.step.tolist(), d.accepts.astype(bool).tolist(), d.start, d.dead) for d in compiled.forward]
        d = compiled.combined
        # A state is the list of its successors; an accepting one is longer by its rules' bits, so that its length tells them.
        states: list[list] = [[] for _ in range(len(d.step))]
        for q, row in enumerate(states):
            row.extend(map(states.__getitem__, d.step[q].tolist()))
            row.extend([row] * int(d.accepts[q]))
        self.first = states[d.start]

    def starts(self, data: bytes) -> list[np.ndarray]:
        """For each rule, the positions at which some match of it starts, in order: the one pass over the bytes."""
        sizes = np.fromiter(map(len, accumulate(data[::-1], operator.getitem, initial=self.first)), np.int16, len(data) + 1)
        hits = np.flatnonzero(sizes > 256)[::-1]
        bits = sizes[hits] - 256
        return [len(data) - hits[(bits >> k & 1).astype(bool)] if len(hits) else hits for k in range(len(self.rules))]

    def _longest(self, k: int, data: bytes, at: int, barren: set[tuple[int, int]]) -> int:
        """The end of rule ``k``'s longest match from ``at``. ``barren`` holds (position, state) from which no end follows."""
        step, accepts, q, dead = self.forward[k]
        best, since = at, []
        for at in range(at, len(data)):
            q = step[q][data[at]]
            if accepts[q]:
                best = at + 1
                since.clear()
                continue
            if q == dead or (at, q) in barren:
                break
            since.append((at, q))
        barren.update(since)
        return best

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes: leftmost, non-overlapping per rule, those kept by the rule's test."""
        out = []
        for k, starts in enumerate(self.starts(data)):
            i, barren = 0, set()
            while i < len(starts):
                start = int(starts[i])
                end = self._longest(k, data, start, barren)
                if self.rules[k].keep(data[start:end]):
                    out.append((start, k, end))
                i = int(np.searchsorted(starts, max(end, start + 1)))
        return sorted(out)

    def scan(self, text: str) -> list[tuple[int, int, int]]:
        """(start, rule, end) in code points, the end exclusive."""
        data = text.encode("utf-8", "surrogatepass")
        found = self.spans(data)
        if not found or len(data) == len(text):
            return found
        marks = sorted({x for a, _, b in found for x in (a, b)})
        place, at, last = {}, 0, 0
        for m in marks:
            at += len(data[last:m].decode("utf-8", "surrogatepass"))
            place[m], last = at, m
        return [(place[a], k, place[b]) for a, k, b in found]


def joined(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...] = RULES) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in spans)


def scan_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of every whole text.

    Null and empty texts have no spans, repeated rows and rows without an id stay, an empty table gives an empty one, and
    of the other columns, whatever their names, none is read. A very long text takes time in proportion to its length
    and the memory of one state a byte. Matches of different kinds may overlap; equal starts stand in the rules' order.
    """
    blob = Shared(df.sparkSession, pickle.dumps(compile_rules()))

    def kernel(texts: list[str]) -> list[list]:
        scanner = blob.get(lambda b: Scanner(pickle.loads(b)))
        found = [scanner.scan(t) for t in texts]
        base = [[s for s in f if s[1] < len(BASE)] for f in found]
        counts = [[sum(s[1] == k for s in b) for b in base] for k in range(len(BASE))]
        return [*counts, [hashlib.sha256(joined(b).encode()).hexdigest() for b in base], [joined(f) for f in found]]

    return map_texts(df, id_col, text_col, f"{id_col} long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", kernel)
