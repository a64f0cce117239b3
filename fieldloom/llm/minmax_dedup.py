"""Near-duplicates by min-max hashing (operator 4).

Each text becomes the set of its five-word shingles. Texts of equal sets are one class, kept under its smallest id.
For every class ``PERMUTATIONS`` permutations are evaluated once per shingle and both their minimum and their
maximum are kept, which gives twice as many signature values; four of them make a band. At a similarity of 0.75
four values agree with probability 0.32, so 32 bands miss a link with probability 5e-6.

Links are confirmed on the full sets. What is wanted is components, so buckets are never expanded into all their
pairs. Neighbours in a hash order of some bands' buckets are compared first, then each bucket's rows with the one row
that shares most with others; the links found join most of a large group. Then only buckets that still hold several components are opened: all pairs
across components of which one is not the bucket's largest are confirmed. Every pair in a bucket is thus either
confirmed, already joined, or ruled out by a bound: two sets have in common at most those shingles that either one
shares with any set at all, less those whose bit in a small mark the other side lacks. No link that a bucket holds
is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Scratch, map_texts

SHINGLE, PERMUTATIONS, ROWS = 5, 64, 4
BANDS = 2 * PERMUTATIONS // ROWS
NUMERATOR, DENOMINATOR = 75, 100
MARK_BITS = 2048
SPLITMIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_rng = np.random.default_rng(20)
_odd = lambda n: _rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _PLACES, _SCALE, _SHIFT = int(_odd(1)[0]), _odd(SHINGLE + 1), _odd(PERMUTATIONS), _odd(PERMUTATIONS)
_BACK = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(SPLITMIX[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(SPLITMIX[1])
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:  # up to the next power of two, so that slightly longer data don't ask for new ones
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a byte string and their first positions."""
    b = np.frombuffer(data, np.uint8)
    blank = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    first, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(_POWERS[0]) <= len(b):
        _POWERS[0], _POWERS[1] = _powers(_BASE, len(b) + 1), _powers(_BACK, len(b) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _POWERS[0][: len(b)], dtype=np.uint64)])
    return _mix((total[stop] - total[first]) * _POWERS[1][first] + (stop - first).astype(np.uint64)), first


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words has one, of the whole sequence."""
    parts = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    with np.errstate(over="ignore"):
        words, first = word_hashes(b"\n".join(parts))
        bounds = np.searchsorted(first, np.cumsum([0, *(len(p) + 1 for p in parts)]))
        n = len(words) - SHINGLE + 1
        rows = np.zeros(max(n, 0), np.uint64)
        for k in range(SHINGLE if n > 0 else 0):
            rows += words[k : k + n] * _PLACES[k]
        rows = _mix(rows)
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= SHINGLE:
                out.append(np.unique(rows[a : b - SHINGLE + 1]))
            elif b > a:
                few = (words[a:b] * _PLACES[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a) * _PLACES[SHINGLE]
                out.append(_mix(_mix(few)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def marks_of(x: np.ndarray) -> np.ndarray:
    """A bit for each element's hash modulo ``MARK_BITS``, as 64-bit words."""
    seen = np.zeros(MARK_BITS, bool)
    seen[(x % np.uint64(MARK_BITS)).astype(np.int64)] = True
    return np.packbits(seen).view(np.int64)


def _sets_and_marks(texts: list[str]) -> list[list]:
    sets = shingle_sets(texts)
    return [[x.view(np.int64) for x in sets], [marks_of(x) for x in sets]]


def band_keys(x: np.ndarray) -> np.ndarray:
    """One key per band from the minima and the maxima of all permutations; the band's number is in the low bits."""
    with np.errstate(over="ignore"):
        low, high = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64), np.zeros(PERMUTATIONS, np.uint64)
        for i in range(0, len(x), 2048):
            h = x[i : i + 2048, None] * _SCALE + _SHIFT
            low, high = np.minimum(low, h.min(axis=0)), np.maximum(high, h.max(axis=0))
        v = _mix(np.concatenate([low, high])).reshape(BANDS, ROWS) * _PLACES[:ROWS]
        key = _mix(v.sum(axis=1, dtype=np.uint64))
    bits = np.uint64(BANDS.bit_length())
    return ((key << bits) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def profiles(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, set_key, keys) per row; texts without words have no set_key and no keys."""

    def kernel(texts: list[str]) -> list[list]:
        sets = shingle_sets(texts)
        return [
            [len(s) for s in sets],
            [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets],
            [band_keys(s) if len(s) else None for s in sets],
        ]

    return map_texts(df, id_col, text_col, "id long, n long, set_key binary, keys array<long>", kernel)


def _sorted_buckets(rows: DataFrame, salt: int, parts: int) -> DataFrame:
    """Rows ordered by bucket and, in it, by a hash. The id is part of the order, so a large bucket spreads over many tasks."""
    h = F.xxhash64(F.lit(salt), "key", "id")
    return rows.withColumn("h", h).repartitionByRange(parts, "key", "h", "id").sortWithinPartitions("key", "h", "id").drop("h")


def shared_buckets(rows: DataFrame, parts: int) -> DataFrame:
    """(key, id, prev): rows of buckets with several ids, with the id before in the bucket's order.

    A bucket that touches its task's border stays even if it looks single there, and has no ``prev`` across it.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ids = np.zeros(0, np.int64)
        fresh = True  # the pending rows begin at the task's border
        prev_of_first = None

        def emit(key: np.ndarray, ids: np.ndarray, before: tuple | None, head: bool, tail: bool) -> pa.RecordBatch:
            n = len(key)
            same = np.zeros(n, bool)
            same[1:] = key[1:] == key[:-1]
            prev = np.concatenate([[0], ids[:-1]])
            if before is not None and n and before[0] == key[0]:
                same[0], prev[0] = True, before[1]
            keep = same.copy()
            keep[:-1] |= same[1:]
            if n and head:
                keep |= key == key[0]
            if n and tail:
                keep |= key == key[-1]
            good = same & (prev != ids)
            return pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(ids[keep]), pa.array(prev[keep], mask=~good[keep])], names=["key", "id", "prev"])

        for b in batches:
            k, i = (np.concatenate([x, b.column(c).to_numpy()]) for c, x in ((0, key), (1, ids)))
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))  # the last bucket may go on
            if cut == 0 and len(k) > 1:
                cut = len(k) - 1  # one bucket fills the batch: hand on all but its last row, it is shared in any case
                yield emit(k[:cut], i[:cut], prev_of_first, True, True)
                prev_of_first, key, ids = (k[cut - 1], i[cut - 1]), k[cut:], i[cut:]
                continue
            if cut:
                yield emit(k[:cut], i[:cut], prev_of_first, fresh, False)
                fresh, prev_of_first = False, None
            key, ids = k[cut:], i[cut:]
        if len(key):
            yield emit(key, ids, prev_of_first, fresh, True)

    return _sorted_buckets(rows, 1, parts).select("key", "id").mapInArrow(run, "key long, id long, prev long")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, comp) for every id in the (a, b) rows, with the smallest id it reaches; by alternating stars."""
    e = scratch.save(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    print_of = lambda d: d.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 31)).alias("s")).first()
    mark = print_of(e)
    while mark["n"]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        tip = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(tip, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
        new = scratch.save(small.unionByName(tip.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        now = print_of(new)
        scratch.drop(e)
        e = new
        if now == mark:
            break
        mark = now
    return e.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("comp"))).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) rows whose full sets are similar enough."""
    x = sets.select(F.col("id").alias("xa"), F.col("s").alias("sa"))
    y = sets.select(F.col("id").alias("yb"), F.col("s").alias("sb"))
    p = pairs.join(x, F.col("a") == F.col("xa")).join(y, F.col("b") == F.col("yb"))
    na, nb = F.size("sa"), F.size("sb")
    p = p.filter((F.least(na, nb) * DENOMINATOR >= F.greatest(na, nb) * NUMERATOR)).withColumn("c", F.size(F.array_intersect("sa", "sb")))
    return p.filter(F.col("c") * DENOMINATOR >= (na + nb - F.col("c")) * NUMERATOR).select("a", "b")


def shared_counts(sets: DataFrame) -> DataFrame:
    """(s_id, n, both): the size of each set and how many of its shingles another set has too.

    Rows of equal id may hold several sets: ``n`` is the smallest one's size and ``both`` counts for all of them, so that
    what rules out a pair of ids rules out each of their sets.
    """
    each = sets.select("id", F.explode("s").alias("x")).groupBy("x").agg(F.count("*").alias("c"), F.min("id").alias("id"))
    alone = each.filter("c = 1").groupBy(F.col("id").alias("a_id")).agg(F.count("*").alias("alone"))
    sizes = sets.groupBy(F.col("id").alias("s_id")).agg(F.min(F.size("s")).cast("long").alias("n"), F.max(F.size("s")).alias("most"), F.sum(F.size("s")).alias("every"))
    out = sizes.join(alone, F.col("s_id") == F.col("a_id"), "left")
    return out.select("s_id", "n", F.least(F.col("every") - F.coalesce("alone", F.lit(0)), F.col("most")).alias("both"))


def _can(both: str, n: str, other_both: str, other_n: str) -> Column:
    """Whether two sets may be similar: they have at most the shared shingles of either in common, and the union is the rest of both."""
    return F.least(both, other_both) * (DENOMINATOR + NUMERATOR) >= (F.col(n) + F.col(other_n)) * NUMERATOR


def _differ(marks: str, other: str) -> Column:
    """At least so many elements of the first set are not in the second: bits that only the first one's mark has."""
    return F.aggregate(F.zip_with(marks, other, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))), F.lit(0), lambda s, x: s + x)


def _ordered(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()


def classes_of(df: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Profiles of all rows, and (id, comp) of the class representatives that have links."""
    spark, since = df.sparkSession, scratch.n
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = scratch.save(profiles(df, id_col, text_col))
    own = rows.filter("set_key is not null and id is not null")
    reps = scratch.save(own.groupBy("set_key").agg(F.min("id").alias("id"), F.any_value("keys").alias("keys")))
    found = scratch.save(shared_buckets(reps.select("id", F.explode("keys").alias("key")), parts))
    # Full sets of the classes that share a bucket; of several rows with a representative's id, those of its own class count.
    wanted = found.select(F.col("id").alias("w")).distinct()
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(wanted, F.col("id") == F.col("w"), "left_semi")
    sets = scratch.save(map_texts(source, "id", "text", "id long, s array<long>, marks array<long>", _sets_and_marks).filter("size(s) > 0"))
    found = scratch.save(found.join(shared_counts(sets), F.col("id") == F.col("s_id")).drop("s_id").filter(F.col("both") * DENOMINATOR >= F.col("n") * NUMERATOR))
    pairs = _ordered(found.filter("prev is not null").filter(F.expr(f"pmod(key, {BANDS}) % 4 = 0")), "id", "prev")
    # An id of several sets ties their classes together: it is linked with the representatives that are not itself.
    several = own.groupBy(F.col("id").alias("o_id")).agg(F.min(F.xxhash64("set_key")).alias("lo"), F.max(F.xxhash64("set_key")).alias("hi")).filter("lo < hi")
    tied = own.join(several, F.col("id") == F.col("o_id"), "left_semi").select("id", F.col("set_key").alias("o_key"))
    tied = tied.join(reps.select("set_key", F.col("id").alias("rep")), F.col("o_key") == F.col("set_key")).select("id", "rep")
    links = scratch.save(confirmed(pairs, sets).unionByName(_ordered(tied, "id", "rep")))
    for last in (False, True):
        comp = components(links, scratch).select(F.col("id").alias("c_id"), "comp")
        placed = found.join(comp, F.col("id") == F.col("c_id"), "left").select("key", "id", "prev", "n", "both", F.coalesce("comp", "id").alias("comp"))
        many = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select(F.col("key").alias("k"))
        mixed = scratch.save(placed.join(many, F.col("key") == F.col("k"), "left_semi"))
        if not last:  # every row with its bucket's hub, the one of which the largest share occurs elsewhere
            hub = mixed.groupBy(F.col("key").alias("k")).agg(F.max(F.struct((F.col("both") / F.col("n")).alias("share"), (-F.col("id")).alias("id"), "comp", "n", "both")).alias("hub"))
            with_hub = mixed.join(hub, (F.col("key") == F.col("k")) & (F.col("comp") != F.col("hub.comp")) & _can("both", "n", "hub.both", "hub.n"))
            more = _ordered(with_hub.select("id", (-F.col("hub.id")).alias("m_id")), "id", "m_id")
        else:
            size = mixed.groupBy(F.col("key").alias("k"), F.col("comp").alias("c")).agg(F.count("*").alias("members"))
            top = size.groupBy("k").agg(F.max_by("c", F.struct("members", "c")).alias("top"))
            marks = sets.select(F.col("id").alias("k_id"), F.size("s").cast("long").alias("own_n"), "marks")
            mixed = scratch.save(mixed.join(marks, F.col("id") == F.col("k_id")))
            minor = mixed.join(top, F.col("key") == F.col("k")).filter("comp <> top").select(
                F.col("key").alias("m_key"), F.col("id").alias("m_id"), F.col("comp").alias("m_comp"), F.col("n").alias("m_n"), F.col("both").alias("m_both"), F.col("own_n").alias("m_own_n"), F.col("marks").alias("m_marks"), "top"
            )
            most = F.col("own_n") - _differ("marks", "m_marks")
            alike = most * (DENOMINATOR + NUMERATOR) >= (F.col("own_n") + F.col("m_own_n")) * NUMERATOR
            once = (F.col("comp") == F.col("top")) | (F.col("id") < F.col("m_id"))
            across = mixed.join(minor, (F.col("key") == F.col("m_key")) & (F.col("comp") != F.col("m_comp")) & _can("both", "n", "m_both", "m_n") & once & alike)
            more = _ordered(across, "id", "m_id")
        links = scratch.save(links.unionByName(confirmed(more, sets)))
    out = scratch.save(components(links, scratch))
    scratch.keep_only(rows, out, since=since)
    return rows, out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row.

    A null text and one without words have an empty set and are linked with nothing. Rows of equal id are one
    document: their links count for each other. A row without an id takes its class' component but forms no link.
    """
    scratch = scratch or Scratch(df.sparkSession)
    rows, comp = classes_of(df, id_col, text_col, scratch)
    reps = rows.filter("set_key is not null").groupBy(F.col("set_key").alias("r_key")).agg(F.min("id").alias("rep"))
    reps = reps.join(comp.withColumnRenamed("id", "c_id"), F.col("rep") == F.col("c_id"), "left").select("r_key", F.coalesce("comp", "rep").alias("comp"))
    out = rows.join(reps, F.col("set_key") == F.col("r_key"), "left").withColumn("comp", F.coalesce("comp", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"), F.col("id").eqNullSafe(F.col("comp")).alias("kept"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of one document of each group, its smallest id, with all their columns."""
    kept = near_duplicates(df, id_col, text_col).filter("kept").select(F.col(id_col).alias("__kept_id")).distinct()
    return df.join(kept, F.col(f"`{id_col}`").eqNullSafe(F.col("__kept_id")), "left_semi")


#: The same in SQL: exact shingle sets, all pairs that share a shingle, and the closure of the links.
NEAR_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS x FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
g AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, g.component_id, d.doc_id = g.component_id AS kept FROM d JOIN g ON g.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
