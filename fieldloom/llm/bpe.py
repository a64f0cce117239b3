"""Exact byte-pair merging and the parts of a published tokenizer file."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np

#: Words of up to so many bytes are merged together, by classes of length; longer ones one by one.
TOGETHER = (4, 8, 12, 16, 24, 32, 64)


#: Letters of the Unicode version that the tokenizer's patterns know and Python's tables don't, as first-last; then its digits.
NEWER_LETTERS = """
1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B 1138E-1138E 11390-113B5
113B7-113B7 113D1-113D1 113D3-113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF-18CFF 1E5D0-1E5ED 1E5F0-1E5F0
"""
NEWER_DIGITS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"


def newer_code_points(runs: str) -> list[int]:
    return [i for run in runs.split() for a, b in [run.split("-")] for i in range(int(a, 16), int(b, 16) + 1)]


class PairTable:
    """Merge ranks of pairs of ids in an open-addressing table, looked up for many pairs at once."""

    def __init__(self, pairs: np.ndarray):
        """``pairs[r]`` holds the two ids that the merge of rank r joins."""
        self.none = len(pairs)
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, self.none, np.int32)
        todo, key = np.arange(len(pairs), dtype=np.int32), pairs[:, 0].astype(np.int64) << 32 | pairs[:, 1]
        at = self._home(key)
        while len(todo):
            free = self.keys[at] < 0
            first = np.unique(at[free], return_index=True)[1]
            won = np.flatnonzero(free)[first]
            self.keys[at[won]], self.ranks[at[won]] = key[won], todo[won]
            left = np.ones(len(todo), bool)
            left[won] = False
            todo, key, at = todo[left], key[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of the pairs; ``none`` for pairs that don't merge."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = self._home(key)
        held = self.keys[at]
        out = np.where(held == key, self.ranks[at], np.int32(self.none))
        open_ = np.flatnonzero((held != key) & (held >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out


def byte_symbols() -> list[str]:
    """The visible character that byte-level vocabularies write for each byte (a public convention)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return [out[b] for b in range(256)]


class Merger:
    """Vocabulary and merge ranks of a ``tokenizers`` BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(a, b): r for r, (a, b) in enumerate(pairs)}
        self.added: dict[str, int] = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.symbols = byte_symbols()
        self.first = np.array([self.vocab[x] for x in self.symbols], np.int32)
        self.last = np.array([self.vocab[x + self.suffix] for x in self.symbols], np.int32)
        pairs = np.array([(self.vocab[a], self.vocab[b]) for a, b in self.rank], np.int64).reshape(-1, 2)
        self.pairs = PairTable(pairs)
        self.joined = np.array([self.vocab[a + b] for a, b in self.rank], np.int32)

    def tokens(self, word: bytes) -> list[str]:
        """Merge the lowest-ranked pair, leftmost first, until none is left; only the pairs beside a merge are ranked anew."""
        s = [self.symbols[b] for b in word]
        if s and self.suffix:
            s[-1] += self.suffix
        get, none = self.rank.get, len(self.rank)
        ranks = [get(p, none) for p in zip(s, s[1:])]
        while ranks and (best := min(ranks)) != none:
            i = ranks.index(best)
            del ranks[i]
            new = s[i] = s[i] + s.pop(i + 1)
            if i:
                ranks[i - 1] = get((s[i - 1], new), none)
            if i < len(ranks):
                ranks[i] = get((new, s[i + 1]), none)
        return s

    def long_tokens(self, word: bytes) -> list[str]:
        """The same result in O(n log n), for very long words."""
        import heapq

        s = [self.symbols[b] for b in word]
        if s and self.suffix:
            s[-1] += self.suffix
        n = len(s)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, s[i], s[i + 1]) for i in range(n - 1) if (r := self.rank.get((s[i], s[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i] if s[i] else n
            if j >= n or s[i] != a or s[j] != b:
                continue
            s[i], s[j] = a + b, ""
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for p, q in ((prv[i], i), (i, nxt[i])):
                if p >= 0 and q < n and (r := self.rank.get((s[p], s[q]))) is not None:
                    heapq.heappush(heap, (r, p, s[p], s[q]))
        return [x for x in s if x]

    def encode(self, word: bytes) -> list[int]:
        return [self.vocab[t] for t in (self.tokens(word) if len(word) < 200 else self.long_tokens(word))]

    def _together(self, sym: np.ndarray) -> np.ndarray:
        """Merge rows of symbol ids (filled up with -1), in every row the lowest-ranked pair, leftmost first, one a round."""
        out, none = sym.copy(), self.pairs.none
        place = np.arange(sym.shape[1] - 1)
        ranks = np.full((len(sym), len(place)), none, np.int32)
        full = sym[:, 1:] >= 0
        ranks[full] = self.pairs(sym[:, :-1][full], sym[:, 1:][full])
        live = np.arange(len(sym))
        while len(live):
            row = np.arange(len(live))
            at = ranks.argmin(axis=1)
            best = ranks[row, at]
            if (best == none).any():
                go = best != none
                out[live[~go]] = sym[~go]
                live, sym, ranks, at, best = live[go], sym[go], ranks[go], at[go], best[go]
                row = row[: len(live)]
                if not len(live):
                    break
            sym[row, at] = new = self.joined[best]
            later = place > at[:, None]  # what stands behind the merged pair moves up
            sym[:, 1:-1] = np.where(later[:, :-1] | (place[:-1] == at[:, None]), sym[:, 2:], sym[:, 1:-1])
            sym[:, -1] = -1
            ranks[:, :-1] = np.where(place[:-1] >= at[:, None], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = none
            b = np.flatnonzero(at > 0)
            ranks[b, at[b] - 1] = self.pairs(sym[b, at[b] - 1], new[b])
            a = np.flatnonzero(sym[row, at + 1] >= 0)
            ranks[a, at[a]] = self.pairs(new[a], sym[a, at[a] + 1])
        return out

    def encode_all(self, words: Sequence[bytes]) -> list[bytes]:
        """Ids of many words at once, each as little-endian unsigned 32-bit integers."""
        out = [b""] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        low = 0
        for high in TOGETHER:
            of = np.flatnonzero((size > low) & (size <= high))
            low = high
            if not len(of):
                continue
            data = np.frombuffer(b"".join(words[i].ljust(high, b"\0") for i in of.tolist()), np.uint8).reshape(-1, high)
            n = size[of]
            sym = np.where(np.arange(high) < n[:, None], self.first[data], np.int32(-1))
            sym[np.arange(len(of)), n - 1] = self.last[data[np.arange(len(of)), n - 1]]
            got = self._together(sym)
            flat, at = got[got >= 0].astype("<u4").tobytes(), 0
            for i, k in zip(of.tolist(), (4 * (got >= 0).sum(axis=1)).tolist()):
                out[i] = flat[at : at + k]
                at += k
        for i in np.flatnonzero(size > TOGETHER[-1]).tolist():
            out[i] = packed(self.encode(words[i]))
        return out

    def id_to_token(self) -> list[str]:
        out = [""] * (1 + max([*self.vocab.values(), *self.added.values()]))
        for t, i in [*self.vocab.items(), *self.added.items()]:
            out[i] = t
        return out


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()
