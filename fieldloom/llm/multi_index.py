"""Nearest neighbours by cosine through an inverted multi-index (operator 5).

Unit vectors are cut into two halves, each quantised by its own codebook, so that every vector falls into one of
K * K cells. A query walks the pairs of centroids by rising summed distance (a heap that opens the next pair in
either direction) until the cells seen hold ``visit`` of all vectors, and at least as many as it takes to find ``top``
of other ids; their entries are reranked exactly.

The codebooks are fitted on about ``SAMPLE_ROWS`` vectors drawn by a hash. On the same sample ``visit`` is set: the
least share with which sample queries find ``AIM`` of their true neighbours, plus a reserve. On data
without structure that is a large part of the table, on clustered data a small one; nothing else depends on it.
All rows are indexed. Cells are dealt to blocks of about ``BLOCK_ROWS`` rows, with large cells split over several.
Every entry is shuffled once, to its block; the queries' probes follow it there and stream past the block's entries, so a
task holds one block and one batch of probes however many there are.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS, CENTROIDS, ROUNDS = 10_000, 64, 12
AIM, RESERVE, TRIAL_QUERIES = 0.95, 0.03, 300
BLOCK_ROWS, AT_ONCE = 4096, 128
SEED = 5


def usable(v: Column, dim: int) -> Column:
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) == dim) & whole & F.exists(v, lambda x: x != 0)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        near = _distances(x, c).argmin(axis=1)
        n = np.bincount(near, minlength=k)
        s = np.zeros_like(c)
        np.add.at(s, near, x)
        c = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], c)
    return c


class Index:
    """Codebooks, cell sizes and what to visit."""

    def __init__(self, sample: np.ndarray, top: int = 5):
        rng = np.random.default_rng(SEED)
        x = _unit(sample)
        self.half = x.shape[1] // 2
        k = max(1, min(CENTROIDS, len(x) // 8))
        self.books = [_codebook(x[:, : self.half], k, rng), _codebook(x[:, self.half :], k, rng)]
        self.k = k
        self.visit = self._calibrated(x, rng, top)
        self.sizes: dict[int, int] = {}

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(x[:, : self.half], self.books[0]), _distances(x[:, self.half :], self.books[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(_unit(x))
        return a.argmin(axis=1) * self.k + b.argmin(axis=1)

    def _calibrated(self, x: np.ndarray, rng: np.random.Generator, top: int) -> float:
        if len(x) < max(50, top + 2):
            return 1.0
        q = rng.choice(len(x), min(TRIAL_QUERIES, len(x)), replace=False)
        cell = self.cells(x)
        needed = []
        for i in range(0, len(q), 50):
            own = q[i : i + 50]
            s = x[own] @ x.T
            s[np.arange(len(own)), own] = -np.inf
            best = np.argpartition(-s, top, axis=1)[:, :top]
            a, b = self.halves(x[own])
            far = a[:, cell // self.k] + b[:, cell % self.k]
            needed += [(far < far[r, j]).mean() for r in range(len(own)) for j in best[r]]
        return min(1.0, float(np.quantile(needed, AIM)) + RESERVE)

    def walk(self, a: np.ndarray, b: np.ndarray, enough: float) -> list[int]:
        """Cells with entries in the order of summed distance, until they hold ``enough`` entries."""
        p, q = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
        a, b, k, sizes = a[p].tolist(), b[q].tolist(), self.k, self.sizes
        heap, reached, got, found = [(a[0] + b[0], 0, 0)], [0] * k, 0, []
        while heap and got < enough:
            _, i, j = heapq.heappop(heap)
            reached[i] = j + 1
            cell = p[i] * k + q[j]
            if n := sizes.get(cell):
                found.append(cell)
                got += n
            if i + 1 < k and reached[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
            if j + 1 < k and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        return found


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near one: exact, and squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])


def _exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines of one query with rows, each worked out alike wherever the row stands, so that equal vectors tie."""
    q, v = _scaled(q), _scaled(v)
    return (v * q).sum(axis=1) / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((q * q).sum()))


def search(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", top: int = 5) -> DataFrame:
    """(query_id, rank, id, score): for each query row the ``top`` nearest other rows found (all, if fewer), ties to the smaller id.

    Vectors that are null, zero, not finite, or of another length than most take no part, nor do rows without an id. Rows of equal
    id are entries of their own, but a query never finds its own id; of several query rows of one id
    the smallest vector asks. An empty table, or one without a usable vector, gives no rows. Of the other columns, whatever their
    names, none is read.
    """
    spark = df.sparkSession
    schema = f"query_id long, rank int, {id_col} long, score double"
    rows = df.select(F.col(id_col).cast("long").alias("v_id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("is_query")).filter("v_id is not null")
    dims = rows.filter("v is not null and size(v) > 0").groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], schema)
    rows = rows.filter(usable(F.col("v"), dims[0]["d"]))
    total = rows.count()
    if not total:
        return spark.createDataFrame([], schema)
    draw = F.pmod(F.xxhash64(F.lit(SEED), "v_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_ROWS / total))
    sample = rows.filter(draw).select("v_id", "v").toPandas().sort_values("v_id")
    if not len(sample):
        sample = rows.limit(1).select("v_id", "v").toPandas()
    index = Index(np.stack(sample["v"].to_numpy()), top)
    code = spark.sparkContext.broadcast(pickle.dumps(index))

    @F.pandas_udf("int")
    def cell_of(v: pd.Series) -> pd.Series:
        return pd.Series(pickle.loads(code.value).cells(np.stack(v.to_numpy())).astype(np.int32)) if len(v) else pd.Series([], dtype="int32")

    placed = rows.withColumn("cell", cell_of("v"))
    index.sizes = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # at most K * K
    blocks, parts, filled, block = {}, {}, 0, 0
    for cell, n in sorted(index.sizes.items()):
        parts[cell] = -(-n // BLOCK_ROWS)
        if parts[cell] > 1 or filled + n > BLOCK_ROWS:
            block, filled = block + (filled > 0), 0
        blocks[cell] = block
        if parts[cell] > 1:
            block += parts[cell]
        else:
            filled += n
    full = spark.sparkContext.broadcast(pickle.dumps((index, blocks, parts)))
    place = spark.createDataFrame([(c, blocks[c], parts[c]) for c in blocks], "p_cell int, p_block int, p_parts int")
    entries = placed.join(F.broadcast(place), F.col("cell") == F.col("p_cell"))  # at most K * K rows
    block = (F.col("p_block") + F.pmod(F.xxhash64("v_id"), F.col("p_parts"))).cast("int").alias("block")
    entries = entries.select(block, F.lit(False).alias("probe"), "v_id", "v", F.array("cell").alias("cells"))
    same = rows.groupBy(F.col("v_id").alias("s_id")).agg(F.count("*").alias("own")).filter("own > 1")
    asked = rows.filter("is_query").groupBy("v_id").agg(F.min("v").alias("v")).join(same, F.col("v_id") == F.col("s_id"), "left")
    asked = asked.select("v_id", "v", F.coalesce("own", F.lit(1)).alias("own"))

    def probes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix, block_of, split = pickle.loads(full.value)
        for f in frames:
            out = []
            if len(f):
                a, b = ix.halves(_unit(np.stack(f["v"].to_numpy())))
                for r, (i, q, own) in enumerate(zip(f["v_id"], f["v"], f["own"])):
                    by_block: dict[int, list[int]] = {}
                    for c in ix.walk(a[r], b[r], max(ix.visit * total, top + own)):
                        for p in range(split[c]):
                            by_block.setdefault(block_of[c] + p, []).append(c)
                    out += [(blk, True, i, q, cs) for blk, cs in by_block.items()]
                    if len(out) > BLOCK_ROWS:
                        yield pd.DataFrame(out, columns=names)
                        out = []
            yield pd.DataFrame(out, columns=names)

    names = ["block", "probe", "v_id", "v", "cells"]
    asked = asked.mapInPandas(probes, "block int, probe boolean, v_id long, v array<double>, cells array<int>")
    n_cells = index.k * index.k

    def rerank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready = None, [], None
        for b in batches:
            blocks_, probe, ids = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            v = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)
            cells, bound = b.column(4).flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(b.column(4).value_lengths().to_numpy())])
            edge = np.flatnonzero((blocks_[1:] != blocks_[:-1]) | (probe[1:] != probe[:-1])) + 1
            for i, j in zip([0, *edge], [*edge, len(b)]):
                if i == j:
                    continue
                if blocks_[i] != at:
                    at, held, ready = blocks_[i], [], None
                if not probe[i]:
                    held.append((ids[i:j], v[i:j], cells[bound[i] : bound[j]]))
                    continue
                if not held:
                    continue
                if ready is None:
                    own, x, of = (np.concatenate(c) for c in zip(*held))
                    order = np.argsort(own, kind="stable")
                    ready = own[order], x[order], of[order], _unit(x[order])
                own, x, of, unit = ready
                out: list[tuple] = []
                for lo in range(i, j, AT_ONCE):
                    hi = min(j, lo + AT_ONCE)
                    near = _unit(v[lo:hi]) @ unit.T
                    for r in range(lo, hi):
                        open_ = np.zeros(n_cells, bool)
                        open_[cells[bound[r] : bound[r + 1]]] = True
                        row = np.where(open_[of] & (own != ids[r]), near[r - lo], -np.inf)
                        n = min(top, int((row > -np.inf).sum()))
                        if not n:
                            continue
                        close = np.flatnonzero(row >= np.partition(row, -n)[-n] - 1e-9)
                        s = _exact(v[r], x[close])
                        out += [(ids[r], own[close[k]], s[k]) for k in np.lexsort((own[close], -s))[:n]]
                cols = list(zip(*out)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], names=["query_id", "v_id", "score"])

    met = entries.unionByName(asked).repartition("block").sortWithinPartitions("block", "probe")
    found = met.mapInArrow(rerank, "query_id long, v_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "v_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", F.col("v_id").alias(id_col), "score")
