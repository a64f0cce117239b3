"""Minimal acyclic transducers: byte strings to integers that add up along the path.

``build`` makes a trie of the words, pushes each word's value as far towards the root as it goes (Mohri's
weight pushing, with the minimum) and merges states of equal right language from the leaves up, so that words
share their suffixes as well as their prefixes. The result lives in flat arrays inside one bytes object, which
can be memory-mapped; ``lookup`` walks many words in lockstep.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from fieldloom.llm.common import mapped_file

_FIELDS = (("key", np.int64), ("target", np.int32), ("weight", np.int32), ("final", np.int32))
#: Value of ``final`` for states in which no word ends.
_NOT_FINAL = -1


def build(words: dict[bytes, int]) -> bytes:
    """Compile {word: value >= 0}. The empty word is allowed."""
    children: list[dict[int, int]] = [{}]
    value: list[int] = [_NOT_FINAL]
    for w in sorted(words):
        node = 0
        for b in w:
            nxt = children[node].get(b)
            if nxt is None:
                nxt = len(children)
                children[node][b] = nxt
                children.append({})
                value.append(_NOT_FINAL)
            node = nxt
        value[node] = words[w]
    n = len(children)
    least = [0] * n
    for v in range(n - 1, -1, -1):  # children have larger numbers than their parents
        found = [least[c] for c in children[v].values()]
        if value[v] != _NOT_FINAL:
            found.append(value[v])
        least[v] = min(found, default=0)
    merged: dict[tuple, int] = {}
    state = [0] * n
    shapes: list[tuple] = []
    for v in range(n - 1, -1, -1):
        shape = (
            value[v] - least[v] if value[v] != _NOT_FINAL else _NOT_FINAL,
            tuple((b, state[c], least[c] - least[v]) for b, c in children[v].items()),
        )
        s = merged.setdefault(shape, len(shapes))
        if s == len(shapes):
            shapes.append(shape)
        state[v] = s
    arcs = sorted((s * 256 + b, t, w) for s, (_, out) in enumerate(shapes) for b, t, w in out)
    parts = {
        "key": np.array([a[0] for a in arcs], np.int64),
        "target": np.array([a[1] for a in arcs], np.int32),
        "weight": np.array([a[2] for a in arcs], np.int32),
        "final": np.array([x[0] for x in shapes], np.int32),
    }
    head = np.array([len(arcs), len(shapes), state[0], least[0]], np.int64)
    return head.tobytes() + b"".join(parts[k].tobytes() for k, _ in _FIELDS)


class Transducer:
    def __init__(self, blob: bytes, mapped: bool = False):
        data = mapped_file("transducer", blob) if mapped else blob
        arcs, states, self.start, self.base = (int(x) for x in np.frombuffer(data, np.int64, 4))
        at = 32
        for name, kind in _FIELDS:
            n = states if name == "final" else arcs
            setattr(self, name, np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
        self.n_states, self.n_arcs = states, arcs

    def lookup(self, words: Sequence[bytes]) -> np.ndarray:
        """The words' values; -1 for words outside the lexicon."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n:
            return out
        size = np.fromiter(map(len, words), np.int64, n)
        at = np.concatenate([[0], np.cumsum(size)])
        data = np.frombuffer(b"".join(words), np.uint8)
        live = np.arange(n)
        state = np.full(n, self.start, np.int64)
        total = np.full(n, self.base, np.int64)
        step = 0
        while len(live):
            done = size[live] == step
            ends = live[done]
            fin = self.final[state[ends]]
            out[ends] = np.where(fin != _NOT_FINAL, total[ends] + fin, -1)
            live = live[~done]
            if not len(live) or not self.n_arcs:
                break
            want = state[live] * 256 + data[at[live] + step]
            pos = np.minimum(np.searchsorted(self.key, want), self.n_arcs - 1)
            hit = self.key[pos] == want
            live, pos = live[hit], pos[hit]
            state[live] = self.target[pos]
            total[live] += self.weight[pos]
            step += 1
        return out
