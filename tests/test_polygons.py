import random

import pytest
from pyspark.sql import functions as F

from fieldloom.config import Settings, upsert_record
from fieldloom.functions import geometry as g
from fieldloom.functions import names
from fieldloom.operators import exchange, polygons, propagate, sampling, spatial
from fieldloom.sources import gpkg


def shapes(spark, boxes, more="", extra=()):
    rows = [(i, g.write_wkb(g.box(*b)), *(extra[i] if extra else ())) for i, b in enumerate(boxes)]
    df = spark.createDataFrame(rows, "id long, wkb binary" + more)
    return polygons.with_bounds(df).withColumn("area", polygons.st_area("wkb"))


def test_box_join_equals_nested_loops(spark):
    rng = random.Random(4)
    b = [(x := rng.uniform(-50, 50), y := rng.uniform(-50, 50), x + rng.choice([0.1, 3, 40, 400]), y + rng.choice([0.1, 3, 40])) for _ in range(80)]
    df = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(b)], "id long, x0 double, y0 double, x1 double, y1 double")
    got = spatial.box_join(spatial.prefixed(df, "l_"), spatial.prefixed(df, "r_"), 2.0).select("l_id", "r_id").collect()
    want = {(i, j) for i, p in enumerate(b) for j, q in enumerate(b) if p[0] <= q[2] and p[2] >= q[0] and p[1] <= q[3] and p[3] >= q[1]}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_gpkg_round_trip(spark, tmp_path):
    layers = {"Sphagnum": [(g.box(0, 0, 2, 2), {"species": "Sphagnum", "score": 0.5}), ([], {})], "Other": [(g.box(5, 5, 6, 7), {})]}
    (tmp_path / "a.gpkg").write_bytes(gpkg.encode(layers))
    rows = {r["layer"]: r for r in gpkg.read_polygons(spark, str(tmp_path)).collect()}
    assert rows["Sphagnum"]["area"] == 4 and rows["Sphagnum"]["attrs"] == {"species": "Sphagnum", "score": "0.5"} and rows["Other"]["attrs"] == {}
    assert {(r["layer"], r["n"]) for r in gpkg.list_layers(spark, str(tmp_path)).collect()} == {("Sphagnum", 1), ("Other", 1)}


def test_polygon_table_append_delete(spark, tmp_path):
    path = str(tmp_path / "p")
    gpkg.init_layers(spark, path, "s")
    df = shapes(spark, [(0, 0, 1, 1), (2, 2, 3, 3)], ", source string, layer string", [("auto", "A"), (None, "A")]).withColumn("site", F.lit("s"))
    gpkg.append(df.drop("id"), path)
    assert {(r["species"], r["source"]) for r in gpkg.load(spark, path).collect()} == {("A", "auto"), ("A", None)}
    with pytest.raises(ValueError):
        gpkg.init_layers(spark, path, "s")
    assert gpkg.delete(spark, path, F.col("source") == "auto", str(tmp_path / "copy")) == 1
    assert gpkg.load(spark, path).count() == 1 and gpkg.load(spark, str(tmp_path / "copy")).count() == 2


def test_import_is_greedy_and_a_second_run_adds_nothing(spark, scratch):
    b = [(0, 0, 10, 10), (0, 0, 10, 9.9), (50, 50, 60, 60), (95, 0, 110, 10), (20, 20, 30, 30)]
    attrs = [{"n": "A. b"}, {"n": "A_b"}, {"n": "zzz"}, {"n": "A_b"}, {"n": "C"}]
    rows = shapes(spark, b, ", layer string, fid long, part int, attrs map<string,string>", [("l", i, 0, a) for i, a in enumerate(attrs)]).drop("id")
    classes = spark.createDataFrame([("A_b",), ("C",)], "name string")
    none = spark.createDataFrame([], "lb_note string, species string, wkb binary, area double, x0 double, y0 double, x1 double, y1 double")
    args = (classes, "n", "f", (0, 0, 100, 100), {}, 0.5, 0.95, 10.0, scratch)
    new, report = exchange.import_rows(rows, none, *args)
    assert {(r["fid"], r["species"]) for r in new.collect()} == {(0, "A_b"), (4, "C")}
    assert [tuple(r) for r in report.collect()] == [("A. b", 1, 1, 1, 0), ("A_b", 2, 1, 0, 1), ("zzz", 1, 0, 0, 0), ("C", 1, 1, 1, 0)]
    old = new.select(none.columns)
    assert exchange.import_rows(rows, old, *args)[0].count() == 0
    assert exchange.import_rows(rows.withColumn("fid", F.col("fid") + 100), old, *args)[0].count() == 0


def test_export_reasons(spark, scratch):
    b = [(0, 0, 10, 10), (20, 0, 30, 10), (40, 0, 50, 10), (60, 0, 70, 10)]
    extra = [("A", i, 0, "A_b", s) for i, s in enumerate([None, "nesp", "auto", None])]
    rows = shapes(spark, b, ", layer string, fid long, part int, species string, source string", extra).drop("id")
    target = shapes(spark, [(40, 0, 50, 10.01)]).withColumn("id", F.lit(7).cast("long"))
    log = spark.createDataFrame([("A", 3)], "layer string, fid long")
    send, counts = exchange.export_rows(rows, target, log, 10.0, scratch)
    assert [(r["new_id"], r["fid"], r["their_name"]) for r in send.collect()] == [(8, 0, "A. b")]
    assert tuple(counts.first()) == ("A", 4, 1, 1, 1, 1)
    with pytest.raises(ValueError):
        exchange.export_rows(rows, target, log, 10.0, scratch, width=3)


def test_propagation_finds_the_planted_candidate(spark):
    per, size = 6, 84
    tiles = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0, 1.0, 0.0], size, 0.0, 0.0, 84.0, 84.0)], "tile_idx long, transform array<double>, size int, x0 double, y0 double, x1 double, y1 double")
    feat = lambda r, c: [1.0, 0.0, 0.0] if c < 2 else [0.0, 1.0, 0.0] if c < 4 else [0.0, 0.0, 1.0]
    patches = spark.createDataFrame([(0, r, c, feat(r, c)) for r in range(per) for c in range(per)], "tile_idx long, pr int, pc int, feat array<double>")
    s = Settings(min_area=10, max_area=1000, simplify=0.01)
    seeds = shapes(spark, [(1, 1, 13, 13), (43, 1, 55, 13), (57, 1, 69, 13)], ", species string, source string", [("A", None), ("B", "seed"), ("C", "")])
    cand = shapes(spark, [(1, 30, 13, 42), (43, 30, 55, 42), (1.1, 1, 13, 13), (1, 50, 2, 51)])
    library = propagate.candidate_library(cand, "id", tiles, patches, per, 20.0, s)
    assert {r["id"] for r in library.collect()} == {0, 1, 2}
    protos = None
    for sp in "ABC":
        p = propagate.prototype_of(propagate.seeds_of(seeds, sp, s), "id", tiles, patches, per, 20.0, s).withColumn("species", F.lit(sp))
        protos = p if protos is None else protos.unionByName(p)
    new, scored = propagate.propagate(library, "id", seeds, protos, "A", "2020-01-01T00:00:00", 20.0, s)
    got = new.collect()
    assert [(r["id"], r["species"], r["source"], r["score"]) for r in got] == [(0, "A", "auto", 1.0)] and scored.count() == 3


def test_names_and_settings(spark):
    rows = spark.createDataFrame([(x,) for x in ("E. minus", "E.minus", "Empidisma minus", "Empidisma_minus", "Sphagnum", " ", None)], "n string")
    keys = [r[0] for r in rows.select(names.name_key(F.col("n"))).collect()]
    assert len(set(keys[:4])) == 1 and keys[4] == "sphagnum|" and keys[5:] == [None, None]
    assert names.split_source("a.gpkg|layername=x") == ("a.gpkg", "x") and names.split_source("a.shp") == ("a.shp", None)
    with pytest.raises(ValueError):
        names.overrides(["a=b"], {"c"})
    s = Settings.of({"threshold": 0.7, "odd": 1})
    assert s.threshold == 0.7 and s.named()[0] == (1, "Empidisma_minus") and upsert_record('{"a": 1}', {"b": 2, "a": None}).count(":") == 2
    classes = spark.createDataFrame(sorted(s.classes.items()), "class_id int, name string")
    filled = spark.createDataFrame([(0, "Other"), (1, " "), (2, None)], "cluster_id int, species string")
    assert sampling.cluster_classes(filled, classes) == {0: 7, 1: 0, 2: 0}
    with pytest.raises(ValueError, match="x, y"):
        sampling.cluster_classes(spark.createDataFrame([(0, "y"), (1, "x")], "cluster_id int, species string"), classes)


def test_montage_takes_the_first_per_cluster(spark):
    cells = spark.createDataFrame([(f"t{k % 3}", k // 6, k % 6, k % 2) for k in range(36)], "stem string, pr int, pc int, cluster_id int")
    got = sampling.montage_sample(cells, 4, size=84, patches=6).collect()
    assert len(got) == 8 and {r["stem"] for r in got} == {"t0"}


def test_stream_scores_new_files_once(spark, tmp_path):
    from conftest import SF

    from fieldloom.plans import catalogue
    from fieldloom.streaming.scoring import score_stream

    e, p = catalogue._protos(spark, SF)
    src = str(tmp_path / "in")
    e.filter("vec_id < 250").write.mode("append").parquet(src)
    run = lambda: score_stream(spark, src, p, str(tmp_path / "out"), str(tmp_path / "ck"), 3, 0.2, 0.05).awaitTermination()
    run()
    e.filter("vec_id >= 250").write.mode("append").parquet(src)
    run()
    assert {r["vec_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {r["vec_id"] for r in catalogue.QUERIES["one_vs_rest"](spark, SF).collect()}
