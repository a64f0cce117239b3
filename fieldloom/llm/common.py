"""Shared helpers: reading tables, cutting lineage in the shared folder, batching texts."""

from __future__ import annotations

import contextlib
import hashlib
import mmap
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Texts handed to a kernel at once, in characters; a longer text forms a slice of its own.
SLICE_CHARS = 500_000
#: Rows of a batch that are turned into Python strings at once.
STEP_ROWS = 1024
BATCH_ROWS = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a local session gets one of its own; a cluster must name it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='fieldloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Tables written to the shared folder to cut lineage; ``drop`` removes those that are no longer read."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base = spark, f"{shared_dir(spark)}/fieldloom-{uuid.uuid4().hex}"
        self.n = 0

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{self.n}"
        self.n += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *dfs: DataFrame) -> None:
        self._delete(path for df in dfs if (path := getattr(df, "_scratch_path", None)))

    def keep_only(self, *dfs: DataFrame, since: int = 0) -> None:
        """Remove all tables saved from number ``since`` on but the given ones."""
        kept = {df._scratch_path for df in dfs}
        self._delete(path for k in range(since, self.n) if (path := f"{self.base}/{k}") not in kept)

    def _delete(self, paths: Iterable[str]) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def small_batches(spark: SparkSession) -> None:
    """Whole texts travel to Python in batches of at most ``BATCH_ROWS``: the default of ten thousand is meant for short rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))


class Shared:
    """Bytes sent to the executors once, and what each Python worker makes of them, kept for its later tasks."""

    _made: dict[str, object] = {}

    def __init__(self, spark: SparkSession, value: bytes | None):
        self.key, self.blob = uuid.uuid4().hex, None if value is None else spark.sparkContext.broadcast(value)

    def get(self, make: Callable[[bytes | None], object]):
        if self.key not in Shared._made:
            Shared._made.clear()
            Shared._made[self.key] = make(None if self.blob is None else self.blob.value)
        return Shared._made[self.key]


def most_frequent(counts: DataFrame, size: int) -> list[str]:
    """About ``size`` of the most frequent words of (word, n) rows, sorted; all, if there are no more.

    A sort with a limit would send that many words from every task to the driver. So the words are first counted by
    classes of their frequency, of which there are under a thousand; the classes that fit are taken whole, and of the next one
    a share drawn by a hash of the word.
    """
    from pyspark.sql import functions as F

    scratch = Scratch(counts.sparkSession)
    kept = scratch.save(counts.withColumn("class", F.floor(F.log2("n") * 16).cast("int")))
    left, edge, share = size, -1, 0.0
    for c, n in sorted(map(tuple, kept.groupBy("class").agg(F.count("*").alias("words")).collect()), reverse=True):
        if n > left:
            edge, share = c, left / n
            break
        left -= n
    drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
    words = sorted(r["word"] for r in kept.filter((F.col("class") > edge) | ((F.col("class") == edge) & drawn)).select("word").collect())
    scratch.drop(kept)
    return words


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that hold about ``limit`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def map_texts(
    df: DataFrame, id_col: str, text_col: str, schema: str, kernel: Callable[[list[str]], Iterable[list]], carry: str = "",
) -> DataFrame:
    """Apply ``kernel`` to slices of whole texts (null: empty). It returns one list per output column after the id.

    ``schema`` starts with the id's column. Only the id and the text leave the JVM, so other columns, whatever
    their names, do no harm.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None
        for b in batches:
            arrow = arrow or _arrow_schema(schema)
            for at in range(0, b.num_rows, STEP_ROWS):
                ids, texts = b.column(0).slice(at, STEP_ROWS), [x or "" for x in b.column(1).slice(at, STEP_ROWS).to_pylist()]
                for i, j in slices(texts):
                    cols = kernel(texts[i:j])
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(i, j - i).cast(arrow.field(0).type), *(pa.array(c, arrow.field(k + 1).type) for k, c in enumerate(cols))], names=names
                    )

    from pyspark.sql import functions as F

    small_batches(df.sparkSession)
    return df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, schema)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _arrow_schema(schema: str) -> pa.Schema:
    pairs = [x.split() for x in schema.split(", ")]
    return pa.schema([(n, pa.list_(_TYPES[t[6:-1]]) if t.startswith("array<") else _TYPES[t]) for n, t in pairs])


def mapped_file(kind: str, blob: bytes) -> mmap.mmap:
    """A read-only memory map of ``blob``, shared by the Python workers of one executor.

    The file is a cache under a name made from its content; a new executor writes it again from the broadcast. Older
    files of the same kind are removed: maps that are still in use outlive their names.
    """
    folder, name = tempfile.gettempdir(), f"fieldloom-{kind}-{hashlib.sha256(blob).hexdigest()[:16]}.bin"
    while True:
        try:
            with open(os.path.join(folder, name), "rb") as f:
                return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        except FileNotFoundError:
            os.makedirs(folder, exist_ok=True)
            old = [x for x in os.listdir(folder) if x.startswith(f"fieldloom-{kind}-") and x != name]
            with tempfile.NamedTemporaryFile(dir=folder, delete=False) as f:
                f.write(blob)
            os.replace(f.name, os.path.join(folder, name))
            for x in old:
                with contextlib.suppress(FileNotFoundError):
                    os.remove(os.path.join(folder, x))
