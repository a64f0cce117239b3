"""Overlapping tile grids, patch grids and affine transforms as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PATCH = 14


def tile_count(extent: int, size: int, overlap: int, strict: bool = True) -> int:
    """Tiles along an axis. ``strict`` gives none for an extent within the overlap; otherwise at least one."""
    n = -(-(extent - overlap) // (size - overlap))
    return n if strict else max(1, n)


def tile_grid(spark: SparkSession, width: int, height: int, size: int, overlap: int) -> DataFrame:
    """(row_idx, col_idx, row_off, col_off, actual_h, actual_w, stem), made on the executors from the tile number."""
    cols, rows = tile_count(width, size, overlap), tile_count(height, size, overlap)
    step = size - overlap
    t = spark.range(max(0, rows) * max(0, cols)).select((F.col("id") / cols).cast("long").alias("row_idx"), (F.col("id") % max(1, cols)).alias("col_idx"))
    t = t.withColumn("row_off", F.col("row_idx") * step).withColumn("col_off", F.col("col_idx") * step)
    return t.withColumn("actual_h", F.least(F.lit(size), F.lit(height) - F.col("row_off")).cast("long")).withColumn(
        "actual_w", F.least(F.lit(size), F.lit(width) - F.col("col_off")).cast("long")
    ).withColumn("stem", tile_name(F.col("row_idx"), F.col("col_idx")))


def tile_name(row: Column, col: Column) -> Column:
    return F.format_string("tile_r%04d_c%04d", row.cast("int"), col.cast("int"))


def tile_of_name(name: Column) -> tuple[Column, Column]:
    part = lambda k: F.regexp_extract(name, r"tile_r(\d+)_c(\d+)", k).cast("int")
    return part(1), part(2)


def tiles_over(pixel: Column, extent: int, size: int, overlap: int) -> Column:
    """The 0-based tiles along one axis that cover a pixel, as an array."""
    step, n = size - overlap, tile_count(extent, size, overlap)
    first = F.greatest(F.lit(0), F.ceil((pixel - size + 1) / step)).cast("int")
    last = F.least(F.lit(n - 1), F.floor(pixel / step)).cast("int")
    return F.sequence(first, last)


def patch_extent(pixels: Column) -> Column:
    return F.greatest(F.floor(pixels / PATCH) * PATCH, F.lit(PATCH))


def patch_centre(index: Column, extent: int, patches: int) -> Column:
    """Pixel coordinate of a patch's centre along one axis."""
    return (index + 0.5) * extent / patches


def world(transform: tuple[float, ...], col: Column, row: Column, half: float = 0.5) -> tuple[Column, Column]:
    """World coordinates by an affine (a, b, c, d, e, f), with the pixel-centre offset that raster libraries add."""
    a, b, c, d, e, f = transform
    x, y = col + half, row + half
    return F.lit(c) + x * a + y * b, F.lit(f) + x * d + y * e


def nearest_index(i: Column, target: int, source: int) -> Column:
    """The source cell of a target cell when ``source`` cells are spread over ``target``."""
    return F.least(F.floor(i * source / target), F.lit(source - 1)).cast("long")


#: Means and deviations of red, green and blue that image networks are trained with (public, fixed values).
MEAN, DEVIATION = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)


def normalised(rgb):
    """[height, width, 3] bytes as the centred floats that a network takes, [3, height, width]."""
    import numpy as np

    return ((rgb.astype(np.float32) / 255 - np.float32(MEAN)) / np.float32(DEVIATION)).transpose(2, 0, 1)


def resolution_note(pixel, target):
    """What to do with a raster of this pixel size: ``resample`` finer ones, ``keep`` near ones and ``coarser`` ones, which are never made finer.

    Columns and numbers are both taken.
    """
    from pyspark.sql import Column
    from pyspark.sql import functions as F

    ratio = pixel / target
    if isinstance(ratio, Column):
        return F.when(ratio < 0.98, "resample").when(ratio > 1.02, "coarser").otherwise("keep")
    return "resample" if ratio < 0.98 else "coarser" if ratio > 1.02 else "keep"
