"""Joins of tables with many copies: right results, and no more pairs than between distinct shapes."""

import itertools

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldloom.operators import exchange, polygons, spatial

KINDS = [(0, 0, 10, 10), (1, 0, 11, 10), (4, 4, 14, 14), (40, 40, 50, 50), (5, 5, 5, 5)]


def iou(p, q):
    i = max(0, min(p[2], q[2]) - max(p[0], q[0])) * max(0, min(p[3], q[3]) - max(p[1], q[1]))
    u = (p[2] - p[0]) * (p[3] - p[1]) + (q[2] - q[0]) * (q[3] - q[1]) - i
    return i / u if u > 0 else 0.0


def copies(spark, kinds, n, first=0):
    rows = [(first + k * n + i, *map(float, b)) for k, b in enumerate(kinds) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, x0 double, y0 double, x1 double, y1 double")


@pytest.fixture
def counted(monkeypatch):
    """How many pairs each join of boxes yields."""
    seen, join = [], spatial.box_join

    def wrapped(*a):
        out = join(*a)
        seen.append(out.count())
        return out

    monkeypatch.setattr(spatial, "box_join", wrapped)
    return seen


def test_anti_join_compares_distinct_boxes(spark, counted):
    left, a = copies(spark, KINDS, 40)
    right, b = copies(spark, [(0, 1, 10, 11), (5, 5, 5, 5)], 50, 1000)
    for threshold, inclusive in ((0.3, False), (iou(KINDS[0], (0, 1, 10, 11)), True)):
        hits = lambda p: any(iou(p[1:], q[1:]) > threshold or inclusive and iou(p[1:], q[1:]) == threshold for q in right)  # noqa: E731, B023
        got = [r["id"] for r in spatial.spatial_anti_join(a, b, "id", 5.0, threshold, inclusive).collect()]
        assert sorted(got) == [p[0] for p in left if not hits(p)]
    assert max(counted) <= len(KINDS) * 2


def test_inclusive_anti_join_of_copies(spark, counted):
    left, a = copies(spark, [KINDS[0], KINDS[3]], 100)
    _, b = copies(spark, [(0, 5, 10, 10)], 100, 1000)
    join = lambda t, inclusive: {r["id"] for r in spatial.spatial_anti_join(a, b, "id", 5.0, t, inclusive).collect()}
    assert join(0.5, True) == {p[0] for p in left if p[1] == 40} and join(0.5, False) == {p[0] for p in left}
    assert max(counted) <= 2


def test_best_overlap_of_copies(spark, counted):
    rows, df = copies(spark, KINDS, 30)
    odd = [(0, *map(float, KINDS[2])), (900, 100.0, 0.0, 110.0, 10.0), (900, 101.0, 0.0, 111.0, 10.0), (901, 104.0, 0.0, 114.0, 10.0)]  # ids on several boxes
    rows += odd
    want = {p[0]: m for p in rows if (m := max(iou(p[1:], q[1:]) for q in rows if q[0] != p[0])) > 0}
    want = {k: max(max((iou(p[1:], q[1:]) for q in rows if q[0] != k), default=0) for p in rows if p[0] == k) for k in want}
    got = spatial.self_max_iou(df.unionByName(spark.createDataFrame(odd, df.schema)), "id", 5.0).collect()
    assert {r["id"]: r["max_iou"] for r in got} == pytest.approx(want) and len(got) == len(want)
    assert max(counted) <= 40


def test_pairs_of_copies_are_all_written(spark, counted, monkeypatch):
    monkeypatch.setattr(spatial, "PIECE", 7)
    rows, df = copies(spark, KINDS, 20)
    got = spatial.pairs_once(df, "id", 5.0, 0.05).collect()
    want = {(p[0], q[0]): v for p, q in itertools.combinations(rows, 2) if (v := iou(p[1:], q[1:])) > 0.05}
    assert len(got) == len(want) and {(r["a"], r["b"]): r["iou"] for r in got} == pytest.approx(want)
    assert max(counted) <= 25


def polygon_rows(spark, kinds, n, first=0, **more):
    from fieldloom.functions import geometry as g

    rows = [(first + k * n + i, g.write_wkb(g.box(*map(float, b))), spatial_area(b), *map(float, b)) for k, b in enumerate(kinds) for i in range(n)]
    return spark.createDataFrame(rows, "id long, wkb binary, area double, x0 double, y0 double, x1 double, y1 double")


def spatial_area(b):
    return float((b[2] - b[0]) * (b[3] - b[1]))


def test_polygon_anti_join_compares_distinct_polygons(spark, counted):
    got = polygons.without_duplicates(polygon_rows(spark, KINDS, 40), polygon_rows(spark, [(0, 1, 10, 11)], 50, 1000), "id", 5.0, 0.3).collect()
    assert sorted(r["id"] for r in got) == [k * 40 + i for k, b in enumerate(KINDS) for i in range(40) if iou(b, (0, 1, 10, 11)) <= 0.3]
    assert max(counted) <= len(KINDS)


def test_export_compares_distinct_polygons(spark, scratch, counted):
    rows = polygon_rows(spark, KINDS[:4], 40).select(F.lit("A").alias("layer"), F.col("id").alias("fid"), F.lit(0).alias("part"), F.lit("A_b").alias("species"), F.lit(None).cast("string").alias("source"), *polygons.SHAPE)
    log = spark.createDataFrame([("A", 159)], "layer string, fid long")
    send, counts = exchange.export_rows(rows, polygon_rows(spark, [(0, 1, 10, 11)], 50, 1000), log, 5.0, scratch, 0.6)
    assert tuple(counts.first()) == ("A", 160, 0, 1, 80, 79) and send.count() == 79 and max(counted) <= 4


def test_import_keeps_the_first_of_copies(spark, scratch, counted):
    kinds = [*KINDS[:4], (70, 70, 70, 70)]
    rows = polygon_rows(spark, kinds, 30).select(F.lit("l").alias("layer"), F.col("id").alias("fid"), F.lit(0).alias("part"), F.create_map(F.lit("n"), F.lit("C")).alias("attrs"), *polygons.SHAPE)
    old = polygon_rows(spark, [(40, 40, 50, 50)], 20).select(F.lit(None).cast("string").alias("lb_note"), F.lit("C").alias("species"), *polygons.SHAPE)
    classes = spark.createDataFrame([("C",)], "name string")
    new, report = exchange.import_rows(rows, old, classes, "n", "f", (0.0, 0.0, 100.0, 100.0), {}, 0.0, 0.5, 5.0, scratch)
    # of the first two kinds one polygon is kept; the third overlaps too little; those without area are no duplicates
    assert sorted(r["fid"] for r in new.collect()) == [0, 60, *range(120, 150)]
    assert [tuple(r) for r in report.collect()] == [("C", 150, 150, 32, 118)]
    # what the kernel sees: each kind once
    assert min(counted) <= 4 and sorted(counted)[-1] <= 30 * 30 + 10
    assert exchange.first_copies(new.withColumn("key", F.col("lb_note")).withColumn("ord", F.struct("layer", "fid", "part")), 0.5).count() == 32


def test_a_geometry_is_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("long")
    def size(a: pd.Series) -> pd.Series:
        seen.add(len(a))
        return a.map(len)

    df = polygon_rows(spark, KINDS, 40).unionByName(polygon_rows(spark, KINDS[:1], 1, 500).withColumn("wkb", F.lit(None).cast("binary")))
    got = polygons.per_geometry(df, "wkb", n=F.when(F.col("wkb").isNull(), -1).otherwise(size(F.coalesce("wkb", F.lit(b""))))).collect()
    assert len(got) == 201 and sum(r["n"] == 93 for r in got) == 200 and seen.value <= 2 * (len(KINDS) + 1)


def test_rings_of_several_lengths(spark):
    from fieldloom.functions import geometry as g

    rings = [[0.0, 0.0, 1.0, 0.0, 1.0, 1.0], [0.0, 0.0, 2.0, 0.0, 2.0, 2.0, 0.0, 2.0]]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rings * 3)], "i long, r array<double>").select("i", polygons.st_ring("r").alias("w")).collect()
    assert all(bytes(r["w"]) == g.write_wkb([[*(q := list(zip(v[::2], v[1::2]))), q[0]]]) for r in got for v in [rings[r["i"] % 2]])


def import_of(spark, scratch, rows, old):
    rows = rows.select(F.lit("l").alias("layer"), F.col("id").alias("fid"), F.lit(0).alias("part"), F.create_map(F.lit("n"), F.lit("C")).alias("attrs"), *polygons.SHAPE)
    old = old.select(F.lit(None).cast("string").alias("lb_note"), F.lit("C").alias("species"), *polygons.SHAPE)
    return exchange.import_rows(rows, old, spark.createDataFrame([("C",)], "name string"), "n", "f", (0.0, 0.0, 100.0, 100.0), {}, 0.5, 0.5, 5.0, scratch)


def test_import_compares_each_copy_with_itself_once(spark, scratch, monkeypatch):
    from fieldloom.functions import geometry as g

    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def iou(a: pd.Series, b: pd.Series) -> pd.Series:
        seen.add(len(a))
        return pd.Series([g.iou_of_parts([p], [q]) for x, y in zip(a, b) for p in g.read_wkb(bytes(x)) for q in g.read_wkb(bytes(y))], dtype=float)

    monkeypatch.setattr(polygons, "st_iou", iou)
    _, report = import_of(spark, scratch, polygon_rows(spark, KINDS[:4], 200), polygon_rows(spark, [(40, 40, 50, 50)], 20, 5000))
    assert [tuple(r) for r in report.collect()] == [("C", 800, 800, 2, 798)] and seen.value < 200


def test_rows_read_twice_are_counted_twice(spark, scratch):
    rows = polygon_rows(spark, KINDS[2:4], 1)
    new, report = import_of(spark, scratch, rows.unionByName(rows), polygon_rows(spark, [(80, 80, 90, 90)], 1, 9))
    assert [tuple(r) for r in report.collect()] == [("C", 4, 4, 4, 0)] and new.count() == 4


def test_levels_of_both_sides_are_found_in_one_pass(spark, monkeypatch):
    kind, seen = type(spark.range(1)), []
    collect = kind.collect
    small, a = copies(spark, KINDS, 1)
    large, b = copies(spark, [(0, 0, 900, 300), (3, 3, 6, 6), (45, 40, 49, 50)], 1, 100)
    monkeypatch.setattr(kind, "collect", lambda d: seen.append(1) or collect(d))
    found = spatial.spatial_anti_join(a, b, "id", 5.0, 0.25, True)
    assert len(seen) == 1
    assert sorted(r["id"] for r in found.collect()) == [p[0] for p in small if all(iou(p[1:], q[1:]) < 0.25 for q in large)]
    assert spatial.spatial_anti_join(a, b.limit(0), "id", 5.0, 0.25, True).count() == len(small)
    assert spatial.spatial_anti_join(a.limit(0), b.limit(0), "id", 5.0, 0.25, True).count() == 0
