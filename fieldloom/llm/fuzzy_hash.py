"""Context-triggered piecewise hashing (operator 1).

A rolling hash over the last ``WINDOW`` bytes decides where chunks end: at block size 3 * 2**k after each byte whose
hash plus one is divisible by it. Every chunk gives one signature character. A fingerprint holds the signatures
for the smallest block size that makes at most ``LONGEST`` characters, and for twice and four times that size:
``size:signature:signature:signature``. Two fingerprints are compared at their finest common block size by the
edit distance with insertions and deletions; signatures without a common run of ``RUN`` characters (a third of
the shorter one, if that is less) count as unlike. Texts without bytes are alike one another only.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import small_batches

WINDOW, LONGEST, SPARSE, LEVELS, RUN = 7, 64, 16, 3, 5
PIECE = 1 << 20
#: Stands for a null id among the bounds of buckets: below all ids.
NULL_KEY = -1e300
#: Characters of signatures, in the order of base 64.
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _chunks(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sums of mixed hashes of the finest chunks, and the level up to which each chunk's end is a boundary (-1 for the rest)."""
    sums, levels, carry = [], [], np.uint64(0)
    for at in range(0, len(data), PIECE):
        lead = min(at, WINDOW - 1)
        b = np.frombuffer(data, np.uint8, min(PIECE, len(data) - at) + lead, at - lead).astype(np.uint32) + np.uint32(1)
        h = b * np.uint32(0x01000193)
        for k in range(1, WINDOW):
            h[k:] += b[:-k] * np.uint32(pow(0x2F0B4C47, k + 1, 1 << 32))
        h = h[lead:]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0x297A2D39)
        h ^= h >> np.uint32(16)
        mix = h.astype(np.uint64)
        ends = np.flatnonzero((h % np.uint32(3)) == 2)  # the hash plus one is divisible by 3
        v = mix[ends] + np.uint64(1)
        level = np.zeros(len(ends), np.int8)
        low = v & (~v + np.uint64(1))
        level[:] = np.log2(low.astype(np.float64)).astype(np.int8)
        mix *= np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(29)
        if len(ends):
            starts = np.concatenate([[0], ends[:-1] + 1])
            s = np.add.reduceat(mix, starts)
            s[-1] = np.add.reduce(mix[starts[-1] : ends[-1] + 1])
            s[0] += carry
            sums.append(s)
            levels.append(level)
            carry = np.add.reduce(mix[ends[-1] + 1 :]) if ends[-1] + 1 < len(mix) else np.uint64(0)
        else:
            carry = carry + np.add.reduce(mix)
    sums.append(np.array([carry], np.uint64))
    levels.append(np.array([-1], np.int8))
    return np.concatenate(sums), np.concatenate(levels)


def fingerprint(text: str) -> str:
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return "3:::"
    with np.errstate(over="ignore"):
        sums, level = _chunks(data)
        many = np.bincount(level[:-1], minlength=40)[::-1].cumsum()[::-1] if len(level) > 1 else np.zeros(40, np.int64)
        k = int(np.argmax(many < LONGEST))
        k -= k > 0 and many[k] < SPARSE  # text that repeats itself: the finer size, with the rest in the last character
        parts = []
        for q in range(k, k + LEVELS):
            ends = np.flatnonzero(level >= q)
            starts = np.concatenate([[0], ends[: LONGEST - 1] + 1])
            s = np.add.reduceat(sums, starts)
            s = (s ^ (s >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            parts.append(ALPHABET[(s >> np.uint64(58)).astype(np.int64)].tobytes().decode())
    return f"{3 << k}:" + ":".join(parts)


def common(a: str, b: str) -> tuple[str, str] | None:
    """The signatures of two fingerprints at their finest common block size."""
    (x, *p), (y, *q) = a.split(":"), b.split(":")
    gap = (int(y) // 3).bit_length() - (int(x) // 3).bit_length()
    if abs(gap) >= LEVELS:
        return None
    return (p[gap], q[0]) if gap >= 0 else (p[0], q[-gap])


def _share_run(a: str, b: str) -> bool:
    n = min(RUN, max(1, min(len(a), len(b)) // 3))
    return any(a[i : i + n] in b for i in range(len(a) - n + 1))


def likeness(pairs: list[tuple[str, str]]) -> list[float]:
    """1 - edits / characters for pairs of fingerprints; the edit distances of all pairs are worked out in lockstep.

    The distance with insertions and deletions is |a| + |b| - 2 * (longest common subsequence), and that follows
    from one machine word per pair (signatures have at most 64 characters).
    """
    out = [0.0] * len(pairs)
    todo = []
    for n, (a, b) in enumerate(pairs):
        if a == b:
            out[n] = 1.0
        elif (c := common(a, b)) and c[0] and c[1] and _share_run(*c):
            todo.append((n, *c))
    if not todo:
        return out
    size = max(len(b) for _, _, b in todo)
    first = np.zeros((len(todo), 64), np.uint8)
    second = np.zeros((len(todo), size), np.uint8)
    for r, (_, a, b) in enumerate(todo):
        first[r, : len(a)] = np.frombuffer(a.encode(), np.uint8)
        second[r, : len(b)] = np.frombuffer(b.encode(), np.uint8)
    row = np.full(len(todo), np.iinfo(np.uint64).max, np.uint64)
    for j in range(size):
        same = (first == second[:, j : j + 1]) & (second[:, j : j + 1] > 0)
        match = np.packbits(same, axis=1, bitorder="little").view(np.uint64).ravel()
        u = row & match
        row = (row + u) | (row - u)
    shared = np.unpackbits((~row).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
    for (n, a, b), s in zip(todo, shared.tolist()):
        out[n] = min(1.0, 2.0 * s / (len(a) + len(b)))
    return out


def chained(df: DataFrame, id_col: str, text_col: str, buckets: int) -> tuple[DataFrame, int]:
    """(c_bucket, c_guest, c_id, c_tie, c_text) such that, sorted by all but the text, each bucket's rows are a run of
    the id order, followed by a guest: the first row after the run (after the last run: the very first row).

    The bounds come from quantiles of the ids, a number per bucket; the heads are one row per bucket. An id that several
    quantiles fall on has as many buckets, by ranges of the hash that orders its rows. The second result is the number of buckets.
    """
    from pyspark.ml.feature import Bucketizer

    rows = df.select(F.col(id_col).cast("long").alias("c_id"), F.coalesce(F.col(text_col), F.lit("")).alias("c_text"))
    key = F.coalesce(F.col("c_id").cast("double"), F.lit(NULL_KEY))  # null ids come first
    found = Counter(rows.select(key.alias("k")).approxQuantile("k", [i / buckets for i in range(1, buckets)], 0.1 / buckets)) if buckets > 1 else Counter()
    rows = rows.withColumn("c_tie", F.xxhash64("c_text")).withColumn("c_key", key)
    hot = {c: n for c, n in found.items() if n > 1 and (abs(c) < 2**53 or c == NULL_KEY)}  # keys that stand for one id each
    cuts = sorted({*found, *(float(np.nextafter(c, np.inf)) for c in hot)})
    if cuts:
        rows = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="c_key", outputCol="c_at").transform(rows)
        split = [1, *(hot.get(c, 1) for c in cuts)]
        first = np.concatenate([[0], np.cumsum(split)])[:-1].tolist()
        at = (F.col("c_at") + 1).cast("int")
        part = F.floor((F.col("c_tie") / F.lit(2.0**64) + 0.5) * F.element_at(F.array(*map(F.lit, split)), at))
        part = F.least(part, F.element_at(F.array(*map(F.lit, split)), at) - 1)
        rows = rows.withColumn("c_at", (F.element_at(F.array(*map(F.lit, first)), at) + part).cast("int"))
    else:
        split = [1]
        rows = rows.withColumn("c_at", F.lit(0))
    order = F.struct(F.col("c_key"), F.col("c_id"), F.col("c_tie"))
    heads = sorted((r["c_at"], r["h"]) for r in rows.groupBy("c_at").agg(F.min(order).alias("h")).collect())
    if not heads:
        return rows.select("c_at", F.lit(0).alias("c_guest"), "c_id", "c_tie", "c_text"), 1
    names = "h_id long, h_tie long, h_to int"
    guests = [(h["c_id"], h["c_tie"], heads[i - 1][0]) for i, (_, h) in enumerate(heads)]
    guests = F.broadcast(df.sparkSession.createDataFrame(guests, names))  # one row per bucket
    rows = rows.join(guests, F.col("c_id").eqNullSafe(F.col("h_id")) & (F.col("c_tie") == F.col("h_tie")), "left")
    places = F.array(F.struct(F.col("c_at").alias("at"), F.lit(0).alias("guest")), F.struct(F.col("h_to").alias("at"), F.lit(1).alias("guest")))
    rows = rows.withColumn("c_place", F.explode(F.when(F.col("h_to").isNull(), F.slice(places, 1, 1)).otherwise(places)))
    return rows.select(F.col("c_place.at").alias("c_at"), F.col("c_place.guest").alias("c_guest"), "c_id", "c_tie", "c_text"), sum(split)


def edited(text: str, follower: str) -> str:
    """The text with the last floor(n / 2) code points replaced by the first as many (or all) of the follower."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every whole text.

    The next document is the one that follows in the order of ids, nulls first; rows of equal id follow each other
    in the order of a hash of their text; repeated rows stay. Null texts are empty. A lone document follows itself, and an
    empty table gives no rows. A very long text is hashed whole, in pieces. Of the other columns, whatever their names, none
    is read.
    """
    spark = df.sparkSession
    small_batches(spark)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the row that waits for its follower: bucket, id, text, fingerprint
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            near = likeness([(r[3], r[4]) for r in out] + [(r[3], r[5]) for r in out])
            cols = [[r[i] for r in out] for i in range(5)]
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*cols, near[: len(out)], near[len(out) :]], types)], names=names)

        for b in batches:
            for at, guest, i, text in zip(*(b.column(k).to_pylist() for k in range(4))):
                if guest and (before is None or before[0] != at):
                    continue
                mark = fingerprint(text)
                if before is not None and before[0] == at:
                    _, j, own, own_mark = before
                    new = edited(own, text)
                    out.append((j, len(own), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), own_mark, fingerprint(new), mark))
                before = None if guest else (at, i, text, mark)
            if out:
                yield batch()
                out = []

    rows, parts = chained(df, id_col, text_col, buckets)
    rows = rows.repartitionById(parts, F.col("c_at")).sortWithinPartitions("c_at", "c_guest", F.col("c_id").asc_nulls_first(), "c_tie")
    schema = f"{id_col} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.select("c_at", "c_guest", "c_id", "c_text").mapInArrow(run, schema)
