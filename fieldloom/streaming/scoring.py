"""Scores tiles as they arrive: a stream of patch rows is matched against the prototypes and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fieldloom.operators import vectors


def score_stream(spark: SparkSession, source: str, protos: DataFrame, out: str, checkpoint: str, target, threshold: float, margin: float, id_col: str = "vec_id", vector: str = "embedding") -> StreamingQuery:
    """Read new Parquet files of ``source``, keep rows like ``target`` and append them to ``out``.

    The file source and the checkpoint make a restart go on where it stopped; a batch that is run again writes to
    the same folder of its number, so nothing is entered twice.
    """
    schema = spark.read.parquet(source).schema
    rows = spark.readStream.schema(schema).parquet(source)

    def save(batch: DataFrame, number: int) -> None:
        found = vectors.one_vs_rest(batch, protos, id_col, vector, "proto", "pv", target, threshold, margin)
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
