"""Joins of boxes and polygons over grid bins. Spark plans plain box predicates as nested loops; binned keys make them hash or merge joins."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOX = ("x0", "y0", "x1", "y1")
#: Boxes of more than this many cells are joined on a coarser grid, so that one large box does not fill the exploded table.
MOST_CELLS = 64
#: Rows of one box are written out with those of another in pieces of so many, so that a task is not left with all copies of a box.
PIECE = 1000


def area(p: str = "") -> Column:
    return (F.col(f"{p}x1") - F.col(f"{p}x0")) * (F.col(f"{p}y1") - F.col(f"{p}y0"))


def overlap_area(a: str, b: str) -> Column:
    w = F.least(f"{a}x1", f"{b}x1") - F.greatest(f"{a}x0", f"{b}x0")
    h = F.least(f"{a}y1", f"{b}y1") - F.greatest(f"{a}y0", f"{b}y0")
    return F.greatest(w, F.lit(0)) * F.greatest(h, F.lit(0))


def iou(a: str, b: str) -> Column:
    i = overlap_area(a, b)
    u = area(a) + area(b) - i
    return F.when(u <= 0, 0.0).otherwise(i / u)


def touches(a: str, b: str) -> Column:
    """Boxes that overlap or touch."""
    return (F.col(f"{a}x0") <= F.col(f"{b}x1")) & (F.col(f"{a}x1") >= F.col(f"{b}x0")) & (F.col(f"{a}y0") <= F.col(f"{b}y1")) & (F.col(f"{a}y1") >= F.col(f"{b}y0"))


def _level(p: str, cell: float) -> Column:
    """The grid level (cell size doubles with each) on which a box spans at most about ``MOST_CELLS`` cells."""
    side = F.greatest(F.col(f"{p}x1") - F.col(f"{p}x0"), F.col(f"{p}y1") - F.col(f"{p}y0")) / cell
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(side, F.lit(1.0)) / (MOST_CELLS**0.5)))).cast("int")


def _binned(df: DataFrame, p: str, cell: float, levels: Column) -> DataFrame:
    """One row per level and cell that a box touches."""
    out = df.withColumn("b_level", F.explode(levels))
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("b_level"))
    cells = lambda lo, hi: F.sequence(F.floor(F.col(p + lo) / size), F.floor(F.col(p + hi) / size))
    return out.withColumn("b_x", F.explode(cells("x0", "x1"))).withColumn("b_y", F.explode(cells("y0", "y1")))


def box_join(left: DataFrame, right: DataFrame, cell: float) -> DataFrame:
    """Pairs of rows whose boxes overlap or touch; columns must differ, boxes are l_x0.. and r_x0...

    Each box is entered in the cells of its own level; to meet boxes of other levels it is looked up on every level
    that the other side uses. A pair is reported by one cell only, the one of the larger lower-left corner.
    """
    lv, rv = left.withColumn("l_level", _level("l_", cell)), right.withColumn("r_level", _level("r_", cell))
    used = lv.select(F.lit(0).alias("side"), F.col("l_level").alias("level")).union(rv.select(F.lit(1), "r_level")).distinct().collect()  # a few numbers, found in one job
    ls, rs = (sorted(r["level"] for r in used if r["side"] == k) for k in (0, 1))
    every = sorted({*ls, *rs})
    # a pair meets on the coarser of its two levels
    up = lambda own, other: F.filter(F.array(*[F.lit(x) for x in every]), lambda q: (q == F.col(own)) | ((q > F.col(own)) & F.array_contains(F.array(*[F.lit(x) for x in other]), q)))
    if not every:
        return left.join(right, F.lit(False))
    a = _binned(lv, "l_", cell, up("l_level", rs))
    b = _binned(rv, "r_", cell, up("r_level", ls)).withColumnsRenamed({"b_level": "c_level", "b_x": "c_x", "b_y": "c_y"})
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("b_level"))
    keyed = (F.col("b_level") == F.col("c_level")) & (F.col("b_x") == F.col("c_x")) & (F.col("b_y") == F.col("c_y"))
    once = (F.col("b_x") == F.floor(F.greatest("l_x0", "r_x0") / size)) & (F.col("b_y") == F.floor(F.greatest("l_y0", "r_y0") / size))
    out = a.join(b, keyed & (F.col("b_level") == F.greatest("l_level", "r_level")) & once & touches("l_", "r_"))
    return out.drop("b_level", "b_x", "b_y", "c_level", "c_x", "c_y", "l_level", "r_level")


def prefixed(df: DataFrame, p: str) -> DataFrame:
    return df.select(*[F.col(c).alias(p + c) for c in df.columns])


def iou_pairs(left: DataFrame, right: DataFrame, cell: float, threshold: float, inclusive: bool = False) -> DataFrame:
    pairs = box_join(prefixed(left, "l_"), prefixed(right, "r_"), cell).withColumn("iou", iou("l_", "r_"))
    return pairs.filter(F.col("iou") >= threshold if inclusive else F.col("iou") > threshold)


def alike(df: DataFrame, **aggregates: Column) -> DataFrame:
    """One row per distinct box. Pairs are sought between these, as copies of a box overlap the same others; many copies then cost no more than one."""
    return df.groupBy(*BOX).agg(*[a.alias(c) for c, a in aggregates.items()]) if aggregates else df.select(*BOX).distinct()


def same_box(p: str) -> Column:
    """Whether a row has the box of the prefixed columns."""
    return functools.reduce(Column.__and__, [F.col(c) == F.col(p + c) for c in BOX])


def pairs_once(df: DataFrame, id_col: str, cell: float, threshold: float) -> DataFrame:
    """(a, b, iou) with a < b of the rows whose boxes overlap by more than the threshold: found between distinct boxes, then
    written out for the rows of each."""
    b = alike(df, ids=F.collect_list(id_col))
    ordered = F.struct(*[f"l_{c}" for c in BOX]) <= F.struct(*[f"r_{c}" for c in BOX])
    pairs = iou_pairs(b, b, cell, threshold).filter(ordered).withColumn("own", F.struct(*[f"l_{c}" for c in BOX]) == F.struct(*[f"r_{c}" for c in BOX]))
    pieces = lambda c: F.explode(F.transform(F.sequence(F.lit(0), F.floor((F.size(c) - 1) / PIECE).cast("int")), lambda k: F.slice(c, k * PIECE + 1, PIECE))).alias(c)
    dealt = pairs.filter("size(l_ids) > 0 and size(r_ids) > 0").select(pieces("l_ids"), "r_ids", "own", "iou").select("l_ids", pieces("r_ids"), "own", "iou").repartition("l_ids", "r_ids")
    out = dealt.select(F.explode("l_ids").alias("p"), "r_ids", "own", "iou").select("p", F.explode("r_ids").alias("q"), "own", "iou")
    # rows of one box meet in both orders, those of two boxes in one
    out = out.filter((F.col("p") < F.col("q")) | (~F.col("own") & (F.col("p") != F.col("q"))))
    return out.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "iou")


def spatial_anti_join(left: DataFrame, right: DataFrame, id_col: str, cell: float, threshold: float, inclusive: bool = False) -> DataFrame:
    """Rows of ``left`` without a row of ``right`` above the threshold; rows of ``left`` are not compared with each other."""
    met = iou_pairs(alike(left), alike(right), cell, threshold, inclusive).select(*[f"l_{c}" for c in BOX]).distinct()
    hit = left.join(met, same_box("l_"), "left_semi").select(F.col(id_col).alias("hit_id")).distinct()
    return left.join(hit, F.col(id_col) == F.col("hit_id"), "left_anti")


def self_max_iou(df: DataFrame, id_col: str, cell: float) -> DataFrame:
    """(id, max_iou) of every row with another that overlaps it."""
    b = alike(df, low=F.min(id_col), high=F.max(id_col))
    # a box whose rows share one id is no other box for rows of that id; the best two of different owners serve every row
    owner = F.when(F.col("r_low") == F.col("r_high"), F.col("r_low")).alias("owner")
    pairs = iou_pairs(b, b, cell, 0.0).groupBy(*[f"l_{c}" for c in BOX], owner).agg(F.max("iou").alias("iou"))
    rank = F.row_number().over(Window.partitionBy(*[f"l_{c}" for c in BOX]).orderBy(F.desc("iou"), "owner"))
    best = pairs.withColumn("rank", rank).filter("rank <= 2")
    met = df.select(F.col(id_col).alias("own"), *BOX).join(best, same_box("l_")).filter(F.col("owner").isNull() | (F.col("owner") != F.col("own")))
    return met.groupBy(F.col("own").alias(id_col)).agg(F.max("iou").alias("max_iou"))


def inside_fraction(box: tuple[float, float, float, float]) -> Column:
    x0, y0, x1, y1 = map(F.lit, box)
    w, h = F.least(F.col("x1"), x1) - F.greatest(F.col("x0"), x0), F.least(F.col("y1"), y1) - F.greatest(F.col("y0"), y0)
    return F.when(area() <= 0, 0.0).otherwise(F.greatest(w, F.lit(0)) * F.greatest(h, F.lit(0)) / area())


def greedy_dedup(df: DataFrame, id_col: str, order: str, cell: float, threshold: float, scratch) -> DataFrame:
    """Rows kept by the rule 'accept in order unless an accepted one overlaps by the threshold or more'.

    Without a loop over rows: a row is decided as soon as all earlier rows that conflict with it are. Each round
    accepts those without an undecided earlier conflict and drops the rows that conflict with accepted ones, so a
    round settles every chain's next link in parallel.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(order).alias("ord"), *BOX)
    edges = iou_pairs(rows, rows, cell, threshold, True).select(F.col("l_id").alias("late"), F.col("r_id").alias("early"), (F.struct("l_ord", "l_id") > F.struct("r_ord", "r_id")).alias("after"))
    edges = scratch.save(edges.filter("after").select("late", "early"))
    state = scratch.save(rows.select("id"))
    kept = None
    while not state.isEmpty():
        live = edges.join(state.withColumnRenamed("id", "e_id"), F.col("early") == F.col("e_id"), "left_semi")
        free = state.join(live, F.col("id") == F.col("late"), "left_anti")
        free = scratch.save(free)
        out = edges.join(free.withColumnRenamed("id", "f_id"), F.col("early") == F.col("f_id"), "left_semi").select("late").distinct()
        kept = free if kept is None else kept.unionByName(free)
        state = scratch.save(state.join(free.withColumnRenamed("id", "g_id"), F.col("id") == F.col("g_id"), "left_anti").join(out, F.col("id") == F.col("late"), "left_anti"))
    return df.limit(0) if kept is None else df.join(kept.withColumnRenamed("id", "k_id"), F.col(id_col) == F.col("k_id"), "left_semi")
