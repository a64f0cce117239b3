"""BPE encoding and decoding through a minimal acyclic transducer lexicon (operator 3).

The corpus' most frequent words are compiled, with their ids, into a shared-suffix automaton (``transducer``).
Its value for a word is the word's number, which points into a table of id sequences. Each executor maps the
automaton into memory; words outside it are merged exactly, so the lexicon changes speed and never results.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.bpe import NEWER_DIGITS, NEWER_LETTERS, Merger, newer_code_points, packed
from fieldloom.llm.common import Shared, map_texts, mapped_file, most_frequent
from fieldloom.llm.transducer import Transducer, build

#: The white space of Unicode's property, which the tokenizer's \s stands for.
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_NOT_WHITE = regex.compile(f"[^{SPACES}]+")
#: Python's own split takes these for white space too.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_LATIN = {k: "".join(regex.escape(chr(i)) for i in range(256) if unicodedata.category(chr(i))[0] == k) for k in "LN"}
#: The same for texts within Latin-1, with the classes written out and the commonest alternative first.
_LATIN_WORDS = re.compile(rf"[{_LATIN['L']}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN['N']}]|[^\t-\r \x85\xa0{_LATIN['L']}{_LATIN['N']}]+")
#: Marks that commonly end a run; such runs of ASCII letters need no pattern.
_CLOSING = (",", ".", ";", ":", "!", "?", ")", '"')
_LETTERS_OR_DIGITS = regex.compile(r"[\p{L}\p{N}]")
#: The lower case that the tokenizer gives to capitals which Python's tables don't know.
NEWER_CASE = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEWER_CASE |= {i: i + 0x20 for i in range(0x10D50, 0x10D66)} | {i: i + 0x1B for i in range(0x16EA0, 0x16EB9)}
_NEWER_CAPITALS = re.compile("[" + "".join(map(chr, NEWER_CASE)) + "]")
#: Words compiled into the lexicon: the most frequent ones of the corpus.
LEXICON_WORDS = 100_000
#: Entries a worker keeps of words it has met before it forgets them.
CACHE_WORDS = 400_000
#: Longer words (in scripts without spaces a whole sentence is one) are merged where they occur and not kept.
LONG_WORD = 64
#: Characters read after which a task sends on the words it has counted.
COUNTED_CHARS = 100_000_000
#: Characters after which the distinct runs met so far are split into words, if they aren't many before.
HELD_CHARS = 20_000_000


@functools.cache
def _strict_words() -> regex.Pattern:
    """The same pattern for texts beyond Latin-1: letters and digits that newer Unicode versions than the tokenizer's add are symbols."""
    newer = {*newer_code_points(NEWER_LETTERS), *newer_code_points(NEWER_DIGITS)}
    late = [i for i in range(0x250, 0x110000) if unicodedata.category(c := chr(i)) == "Cn" and i not in newer and _LETTERS_OR_DIGITS.match(c)]
    runs: list[list[int]] = []
    for i in late:
        if runs and runs[-1][1] == i - 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    new = "".join(f"{chr(a)}-{chr(b)}" for a, b in runs)
    letter, digit = rf"(?:(?![{new}])\p{{L}})", rf"(?:(?![{new}])\p{{N}})"
    return regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{digit}|(?:[{new}]|[^{SPACES}\p{{L}}\p{{N}}])+")


def pieces(chunk: str) -> list[str]:
    """The words of a normalised text or of a part of it between white space."""
    if chunk.isascii():
        if chunk.isalpha():
            return [chunk]
        if chunk[-1:] in _CLOSING and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return _LATIN_WORDS.findall(chunk)
    try:
        chunk.encode("latin-1")
    except UnicodeEncodeError:
        return _strict_words().findall(chunk)
    return _LATIN_WORDS.findall(chunk)


def normalised(text: str) -> str:
    """NFC and lower case letter by letter (so without the final sigma's rule); white space stays, as it only parts chunks."""
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
    return text if text.isascii() or not _NEWER_CAPITALS.search(text) else text.translate(NEWER_CASE)


def chunks(text: str) -> list[str]:
    """The runs between white space of a text, normalised. No word reaches over white space, so each run is split on its own."""
    text = normalised(text)
    if any(c in text for c in _SEPARATORS):
        return _NOT_WHITE.findall(text)
    return text.split()


class Words:
    """Splits whole texts into special strings and the runs between white space."""

    def __init__(self, special: Iterable[str]):
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def split(self, text: str) -> Iterator[tuple[str | None, list[str]]]:
        """(special string or None, runs up to it), in order."""
        at = 0
        for m in self.special.finditer(text) if self.special and "<|" in text else ():
            yield m.group(), chunks(text[at : m.start()])
            at = m.end()
        yield None, chunks(text[at:] if at else text)


class Codec:
    """Encodes and decodes with a lexicon; made once per Python worker."""

    def __init__(self, path: str, blob: bytes | None = None):
        self.merger = Merger(path)
        self.words = Words(self.merger.added)
        self.tokens = self.merger.id_to_token()
        self.special = {s: packed([i]) for s, i in self.merger.added.items()}
        self.seen: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.lexicon = None
        if blob is not None:
            data = mapped_file("lexicon", blob)
            n, size = (int(x) for x in np.frombuffer(data, np.int64, 2))
            self.offsets = np.frombuffer(data, np.int64, n + 1, 16)
            at = 16 + 8 * (n + 1)
            self.ids = np.frombuffer(data, "<u4", int(self.offsets[-1]), at)
            at += 4 * int(self.offsets[-1])
            self.lexicon = Transducer(memoryview(data)[at : at + size])

    def resolve(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words: the automaton first, exact merging for the rest."""
        data = [w.encode() for w in words]
        out: list[bytes] = [b""] * len(words)
        rank = self.lexicon.lookup(data) if self.lexicon else np.full(len(words), -1)
        for i in np.flatnonzero(rank >= 0).tolist():
            out[i] = self.ids[self.offsets[rank[i]] : self.offsets[rank[i] + 1]].tobytes()
        rest = np.flatnonzero(rank < 0).tolist()
        for i, x in zip(rest, self.merger.encode_all([data[i] for i in rest])):
            out[i] = x
        return out

    def learn(self, new: set[str]) -> dict[str, bytes]:
        """Ids of runs that this worker has not met, by their distinct words. They are kept for later, but for long ones."""
        parts = {r: pieces(r) for r in new}
        words = [w for w in set(chain.from_iterable(parts.values())) if w not in self.seen]
        if len(self.seen) + len(words) > CACHE_WORDS:
            self.seen.clear()
            words = list(set(chain.from_iterable(parts.values())))
        self.seen.update(zip(words, self.resolve(words)))
        get = self.seen.__getitem__
        out = {r: get(p[0]) if len(p) == 1 else b"".join(map(get, p)) for r, p in parts.items()}
        if len(self.runs) + len(out) > CACHE_WORDS:
            self.runs.clear()
        self.runs.update(x for x in out.items() if len(x[0]) <= LONG_WORD)
        for w in words:
            if len(w) > LONG_WORD:
                del self.seen[w]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = [list(self.words.split(t)) for t in texts]
        known = [[list(map(self.runs.get, rs)) for _, rs in p] for p in parts]
        open_ = [(rs, ids) for p, k in zip(parts, known) for (_, rs), ids in zip(p, k) if None in ids]
        new = self.learn({r for rs, ids in open_ for r, x in zip(rs, ids) if x is None})
        for rs, ids in open_:
            for i, x in enumerate(ids):
                if x is None:
                    ids[i] = new[rs[i]]
        return [b"".join(b"".join(ids) + (self.special[s] if s else b"") for (s, _), ids in zip(p, k)) for p, k in zip(parts, known)]

    def decode(self, ids: bytes) -> str:
        """The file has no decoder, so tokens are joined with spaces."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def word_counts(df: DataFrame, text_col: str, special: Iterable[str]) -> DataFrame:
    """How often each word of up to ``LONG_WORD`` characters occurs in all texts: (word, n). Tasks add up what they have before they send it."""
    special = list(special)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, runs, found, read, held = Words(special), Counter(), Counter(), 0, 0

        def settle() -> None:
            for r, n in runs.items():  # each distinct run is split once
                for w in pieces(r):
                    found[w] += n
            runs.clear()

        def out() -> pa.RecordBatch:
            settle()
            short = [w for w in found if len(w) <= LONG_WORD]
            return pa.RecordBatch.from_arrays([pa.array(short, pa.string()), pa.array([found[w] for w in short], pa.int64())], names=["word", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                for _, rs in words.split(t or ""):
                    runs.update(rs)
                read, held = read + len(t or ""), held + len(t or "")
                if len(runs) > CACHE_WORDS // 2 or held > HELD_CHARS:
                    settle()
                    held = 0
                if len(found) > CACHE_WORDS or read > COUNTED_CHARS:
                    yield out()
                    found.clear()
                    read = 0
        yield out()

    return df.select(F.col(text_col).alias("__text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(df: DataFrame, text_col: str, path: str, size: int = LEXICON_WORDS) -> bytes:
    """About ``size`` of the most frequent words of up to ``LONG_WORD`` characters with their ids, as one block of bytes."""
    merger = Merger(path)
    words = sorted(w.encode() for w in most_frequent(word_counts(df, text_col, merger.added), size))
    ids = merger.encode_all(words)
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int64)
    fst = build({w: r for r, w in enumerate(words)})
    return np.array([len(words), len(fst)], np.int64).tobytes() + offsets.tobytes() + b"".join(ids) + fst


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """(id, ids binary, decoded string) of every whole text.

    Null and empty texts have no ids and decode to an empty text; repeated rows and rows without an id stay; an empty table gives no
    rows. A very long text is a slice of its own, and its words of over ``LONG_WORD`` characters are forgotten after use. Of
    the other columns, whatever their names, none is read. Frequent words that tie for the lexicon's last places are drawn by a
    hash, which changes no result. ``ids`` holds little-endian unsigned 32-bit integers; ``decoded`` is made from them alone.
    """
    blob = Shared(df.sparkSession, compile_lexicon(df, text_col, path, lexicon_words))

    def kernel(texts: list[str]) -> list[list]:
        codec = blob.get(lambda b: Codec(path, b))
        ids = codec.encode(texts)
        return [ids, [codec.decode(x) for x in ids]]

    return map_texts(df, id_col, text_col, f"{id_col} long, ids binary, decoded string", kernel)


def encode_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """The operator's result in digest form, made where the ids are so that they need not travel. Odd rows are treated as there."""
    blob = Shared(df.sparkSession, compile_lexicon(df, text_col, path, lexicon_words))

    def kernel(texts: list[str]) -> list[list]:
        codec = blob.get(lambda b: Codec(path, b))
        ids = codec.encode(texts)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return [[len(x) // 4 for x in ids], [sha(x) for x in ids], [sha(codec.decode(x).encode()) for x in ids]]

    return map_texts(df, id_col, text_col, f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string", kernel)
