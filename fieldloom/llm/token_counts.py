"""Token counts by compiled finite-state transducers (operator 8).

Two deterministic machines do the work. The first reads character classes and marks where the tokenizer's
pre-tokens begin; its transitions carry the number of pre-tokens that they emit (0, 1 or 2, as a few decisions
fall one character late). A batch of texts is one long class sequence cut into chunks: each chunk's state map
(entry state to exit state) is computed on its own, a parallel prefix scan composes the maps, and only then is
every chunk run from its true entry state. The second machine is a minimal acyclic transducer over the corpus'
frequent pre-tokens whose transitions carry emitted-token counts that add up along the path. Pre-tokens outside
it are merged exactly, so counts are always those of the tokenizer.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.bpe import NEWER_DIGITS, NEWER_LETTERS, Merger, newer_code_points
from fieldloom.llm.common import Shared, map_texts, most_frequent, slices
from fieldloom.llm.transducer import Transducer, build

#: Character classes.
OTHER, LETTER, L_STMD, L_RV, L_E, L_L, DIGIT, SPACE, WHITE, APOS, RESET = range(11)
_LETTERS = (LETTER, L_STMD, L_RV, L_E, L_L)
#: States: what the pre-token that is being read is.
S_START, S_LETTERS, S_DIGITS, S_OTHER, S_SPACE, S_WHITE, S_SPACES, S_WHITES, S_APOS, S_APOS_RV, S_APOS_L = range(11)
N_STATES, N_CLASSES, CHUNK, WARM = 11, 11, 256, 12
#: Emissions: a pre-token begins at this character, at the one before, or at both.
HERE, BACK = 1, 2

LEXICON_WORDS = 100_000
CACHE_WORDS = 500_000
#: Longer pre-tokens are merged where they occur and not kept.
LONG_WORD = 64
#: Characters read after which a task sends on the pre-tokens it has counted.
COUNTED_CHARS = 100_000_000


def machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission for (class, state)."""
    nxt = np.zeros((N_CLASSES, N_STATES), np.uint8)
    emit = np.zeros((N_CLASSES, N_STATES), np.uint8)
    run = {DIGIT: S_DIGITS, SPACE: S_SPACE, WHITE: S_WHITE, OTHER: S_OTHER} | dict.fromkeys(_LETTERS, S_LETTERS)
    for c in range(RESET):
        fresh = run.get(c, S_APOS)  # the state after a pre-token that begins with c
        joined = S_OTHER if c == APOS else fresh  # the same after a space that joins it
        blank, kind = c in (SPACE, WHITE), LETTER if c in _LETTERS else c
        for s in range(N_STATES):
            to, out = fresh, HERE
            if s == S_LETTERS and kind == LETTER or s == S_DIGITS and c == DIGIT:
                to, out = s, 0
            elif s == S_OTHER and c in (OTHER, APOS):
                to, out = S_OTHER, 0
            elif s in (S_SPACE, S_WHITE, S_SPACES, S_WHITES) and blank:
                to, out = S_SPACES if c == SPACE else S_WHITES, 0
            elif s == S_SPACE:
                to, out = joined, 0
            elif s == S_SPACES:
                to, out = joined, BACK
            elif s == S_WHITES:
                to, out = fresh, BACK | HERE
            elif s == S_APOS and c == L_STMD:
                to, out = S_START, 0
            elif s == S_APOS and c == L_RV:
                to, out = S_APOS_RV, 0
            elif s == S_APOS and c == L_L:
                to, out = S_APOS_L, 0
            elif s == S_APOS and c in (OTHER, APOS):
                to, out = S_OTHER, 0
            elif s == S_APOS_RV and c == L_E or s == S_APOS_L and c == L_L:
                to, out = S_START, 0
            elif s in (S_APOS_RV, S_APOS_L):  # no contraction: the letter before began a run of letters
                to, out = (S_LETTERS, BACK) if kind == LETTER else (fresh, BACK | HERE)
            nxt[c, s], emit[c, s] = to, out
    emit[RESET, [S_APOS_RV, S_APOS_L]] = BACK
    return nxt, emit


@functools.cache
def class_table() -> np.ndarray:
    """The class of each code point, by the Unicode categories that the tokenizer knows."""
    major = {"L": LETTER, "N": DIGIT}
    t = np.fromiter((major.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    t[newer_code_points(NEWER_LETTERS)], t[newer_code_points(NEWER_DIGITS)] = LETTER, DIGIT
    t[[9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
    for chars, c in (("stmd", L_STMD), ("rv", L_RV), ("e", L_E), ("l", L_L), (" ", SPACE), ("'", APOS)):
        t[[ord(x) for x in chars]] = c
    return t


_NEXT, _EMIT = machine()
_STEP = np.zeros((N_CLASSES, 16), np.uint8)
_STEP[:, :N_STATES] = _NEXT
_STEP = _STEP.ravel()
_OUT = np.zeros((N_CLASSES, 16), np.uint8)
_OUT[:, :N_STATES] = _EMIT
_OUT = _OUT.ravel()


def state_maps(cols: np.ndarray) -> np.ndarray:
    """The state map of each chunk, [chunks, states]; ``cols`` holds class * 16 as [position, chunk]."""
    n = cols.shape[1]
    maps = np.tile(np.arange(N_STATES, dtype=np.intp), (n, 1))
    for j in range(min(WARM, len(cols))):
        maps = _STEP[maps + cols[j][:, None]].astype(np.intp)
    same = (maps == maps[:, :1]).all(axis=1)
    one, many = np.flatnonzero(same), np.flatnonzero(~same)
    state, rest = maps[one, 0], maps[many]
    for j in range(WARM, len(cols)):  # most maps are constant by now and one lane is enough
        state = _STEP[state + cols[j][one]].astype(np.intp)
        if len(many):
            rest = _STEP[rest + cols[j][many][:, None]].astype(np.intp)
    maps[one] = state[:, None]
    maps[many] = rest
    return maps


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Composition of all maps up to and with each chunk, in log2(chunks) parallel steps."""
    maps, gap = maps.copy(), 1
    while gap < len(maps):
        maps[gap:] = np.take_along_axis(maps[gap:], maps[:-gap].copy(), axis=1)
        gap *= 2
    return maps


def starts(classes: np.ndarray) -> np.ndarray:
    """Positions at which pre-tokens begin, in a class sequence whose texts end with RESET."""
    n = len(classes)
    chunks = -(-n // CHUNK)
    padded = np.full(chunks * CHUNK, RESET * 16, np.int16)
    padded[:n] = classes.astype(np.int16) * 16
    cols = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    scan = prefix_scan(state_maps(cols))
    state = np.concatenate([[S_START], scan[:-1, S_START]]).astype(np.intp)
    out = np.empty((CHUNK, chunks), np.uint8)
    for j in range(CHUNK):
        at = state + cols[j]
        out[j] = _OUT[at]
        state = _STEP[at].astype(np.intp)
    emitted = np.ascontiguousarray(out.T).ravel()[:n]
    mark = (emitted & HERE).astype(bool)
    mark[:-1] |= (emitted[1:] & BACK).astype(bool)
    return np.flatnonzero(mark)


class Counts:
    """Counts tokens of whole texts; made once per Python worker."""

    def __init__(self, path: str, blob: bytes | None = None):
        self.merger = Merger(path)
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.merger.added)) + ")") if self.merger.added else None
        self.lexicon = Transducer(blob, mapped=True) if blob is not None else None
        self.seen: dict[str, int] = {}

    def pretokens(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Pre-tokens of all texts in order, how many each text has, and its number of special strings."""
        special = np.zeros(len(texts), np.int64)
        if self.special:
            texts = list(texts)
            for i, t in enumerate(texts):
                if "<|" in t:  # a special string is a token of its own and parts the text around it
                    parts = self.special.split(t)
                    special[i] = len(parts) // 2
                    texts[i] = parts[::2] if special[i] else t
        parts, owner = [], []
        for i, t in enumerate(texts):
            for x in t if isinstance(t, list) else (t,):
                parts.append(x)
                owner.append(i)
        big = "\n".join(parts) + "\n"
        classes = class_table()[np.frombuffer(big.encode("utf-32-le", "surrogatepass"), np.uint32)]
        ends = np.cumsum([len(x) + 1 for x in parts]) - 1
        classes[ends] = RESET
        begin = starts(classes)
        stop = np.empty_like(begin)
        stop[:-1] = begin[1:]
        if len(stop):
            stop[-1] = len(big)
        part = np.searchsorted(ends, begin)
        np.minimum(stop, ends[part], out=stop)
        words = [big[a:b] for a, b in zip(begin.tolist(), stop.tolist())]
        each = np.bincount(np.asarray(owner)[part], minlength=len(texts)) if len(part) else np.zeros(len(texts), np.int64)
        return words, each, special

    def learn(self, new: set[str]) -> dict[str, int]:
        """Tokens of pre-tokens that this worker has not met. They are kept for later, but for long ones."""
        words = list(new)
        data = [w.encode() for w in words]
        found = self.lexicon.lookup(data) if self.lexicon else np.full(len(words), -1)
        rest = np.flatnonzero(found < 0)
        found[rest] = [len(x) // 4 for x in self.merger.encode_all([data[i] for i in rest.tolist()])]
        out = dict(zip(words, found.tolist()))
        if len(self.seen) + len(out) > CACHE_WORDS:
            self.seen.clear()
        self.seen.update(x for x in out.items() if len(x[0]) <= LONG_WORD)
        return out

    def count(self, texts: list[str]) -> list[int]:
        words, each, special = self.pretokens(texts)
        known = list(map(self.seen.get, words))
        if None in known:
            new = self.learn({w for w, n in zip(words, known) if n is None})
            known = [new[w] if n is None else n for w, n in zip(words, known)]
        total = np.concatenate([[0], np.cumsum(np.array(known, np.int64))])
        at = np.concatenate([[0], np.cumsum(each)])
        return (total[at[1:]] - total[at[:-1]] + special).tolist()


def pretoken_counts(df: DataFrame, text_col: str, path: str) -> DataFrame:
    """How often each pre-token of up to ``LONG_WORD`` characters occurs in all texts: (word, n). Tasks add up what they have before they send it."""

    plain = Shared(df.sparkSession, None)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel, found, read = plain.get(lambda _: Counts(path)), Counter(), 0

        def out() -> pa.RecordBatch:
            short = [w for w in found if len(w) <= LONG_WORD]
            return pa.RecordBatch.from_arrays([pa.array(short, pa.string()), pa.array([found[w] for w in short], pa.int64())], names=["word", "n"])

        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            for i, j in slices(texts):
                found.update(kernel.pretokens(texts[i:j])[0])
                read += sum(map(len, texts[i:j]))
                if len(found) > CACHE_WORDS or read > COUNTED_CHARS:
                    yield out()
                    found.clear()
                    read = 0
        yield out()

    return df.select(F.col(text_col).alias("__text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def compile_counts(df: DataFrame, text_col: str, path: str, size: int = LEXICON_WORDS) -> bytes:
    """The transducer of about ``size`` of the most frequent pre-tokens of up to ``LONG_WORD`` characters."""
    words = [w.encode() for w in most_frequent(pretoken_counts(df, text_col, path), size)]
    return build({w: len(x) // 4 for w, x in zip(words, Merger(path).encode_all(words))})


def count_documents(
    df: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = LEXICON_WORDS,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text.

    Null and empty texts have no tokens; repeated rows and rows without an id stay; an empty table gives no rows. A very long
    text is a slice of its own, cut into chunks whose maps are composed, and its pre-tokens of over ``LONG_WORD`` characters are
    forgotten after use. Of the other columns, whatever their names, none is read. ``limit`` tokens are not over it.
    """
    blob = Shared(df.sparkSession, compile_counts(df, text_col, path, lexicon_words))

    def kernel(texts: list[str]) -> list[list]:
        n = blob.get(lambda b: Counts(path, b)).count(texts)
        return [[len(t.encode()) for t in texts], n, [x > limit for x in n]]

    return map_texts(df, id_col, text_col, f"{id_col} long, n_bytes long, n_tokens long, over_limit boolean", kernel)
