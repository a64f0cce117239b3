"""Patch samples for naming clusters, and the table in which people write the names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions import grid, names
from fieldloom.operators import lookup, vectors


def montage_sample(cells: DataFrame, per_cluster: int = 12, seed: int = 42, margin: int = 0, size: int = 512, patches: int = 36) -> DataFrame:
    """(cluster_id, slot, stem, pr, pc, montage row and column): the first patches of each cluster by tile, then by a hash; crops must lie in the tile."""
    y, x = (grid.patch_centre(F.col(c), size, patches) for c in ("pr", "pc"))
    fits = (y >= margin) & (y < size - margin) & (x >= margin) & (x < size - margin)
    order = F.struct("stem", F.xxhash64(F.lit(seed), "stem", "pr", "pc"))
    out = vectors.quota_sample(cells.filter(fits), "cluster_id", order, per_cluster)
    return out.select("cluster_id", "slot", "stem", "pr", "pc", F.col("cluster_id").alias("m_row"), (F.col("slot") - 1).alias("m_col"))


def name_template(cells: DataFrame) -> DataFrame:
    return cells.select("cluster_id").distinct().withColumn("species", F.lit("")).orderBy("cluster_id")


def cluster_classes(template: DataFrame, classes: DataFrame) -> dict[int, int]:
    """The filled-in table as a map; blank names are background, unknown ones are all reported at once."""
    rows = lookup.named_classes(template, classes)
    return {r["cluster_id"]: r["class_id"] for r in rows.collect()}  # one row per cluster


def read_names(spark, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="cluster_id int, species string").withColumn("species", names.clean(F.col("species")))


def read_manifest(spark, path: str) -> DataFrame:
    return spark.read.csv(path, schema="site string, path string", comment="#", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
