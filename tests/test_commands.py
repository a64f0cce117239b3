import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom import __main__ as cli
from fieldloom.functions import geometry as g
from fieldloom.sources import gpkg, tiff

SIDE = 280  # two classes, left and right


@pytest.fixture(scope="module")
def site(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("site")
    _, x = np.mgrid[0:SIDE, 0:SIDE]
    data = np.stack([np.where(x < SIDE // 2, 200, 40), np.where(x < SIDE // 2, 30, 180), x * 0 + 90]).astype(np.uint8)
    (d / "o").mkdir()
    (d / "o/a.tif").write_bytes(tiff.encode(tiff.Raster(data, (1.0, 0.0, 500000.0, 0.0, -1.0, 4000000.0), 32755)))
    settings = {"tile_size": 140, "overlap": 0, "clusters": 2, "min_area": 10, "max_area": 1e6, "simplify": 0.0, "resolution": 2.0, "topk": 1}
    (d / "s.json").write_text(json.dumps(settings))
    return d


def run(site, command, *rest):
    assert cli.main([command, "--config", str(site / "s.json"), *[x.replace("@", f"{site}/") for x in rest]]) == 0


def box(x0, y0, x1, y1):
    """A box in pixels as world coordinates."""
    return g.box(500000.0 + x0, 4000000.0 - y1, 500000.0 + x1, 4000000.0 - y0)


def test_unsupervised_branch_training_and_inference(spark, site):
    run(site, "tile", "--ortho", "@o/a.tif", "--site", "s", "--out", "@tiles")
    run(site, "features", "--tiles", "@tiles", "--site", "s", "--out", "@features")
    run(site, "cluster", "--features", "@features", "--site", "s", "--out", "@cells")
    counts = [spark.read.parquet(f"{site}/{x}").count() for x in ("tiles", "features", "cells")]
    run(site, "tile", "--ortho", "@o/a.tif", "--site", "s", "--out", "@tiles")
    run(site, "features", "--tiles", "@tiles", "--site", "s", "--out", "@features")
    run(site, "cluster", "--features", "@features", "--site", "s", "--out", "@cells")
    assert counts == [spark.read.parquet(f"{site}/{x}").count() for x in ("tiles", "features", "cells")]  # a second run adds nothing
    left = spark.read.parquet(f"{site}/cells").filter("stem = 'tile_r0000_c0000'").groupBy("cluster_id").count().collect()
    assert len(left) == 1 and left[0]["count"] == 100
    run(site, "montage", "--cells", "@cells", "--site", "s", "--out", "@montage")
    (site / "n.csv").write_text(f"cluster_id,species\n{left[0][0]},Sphagnum\n{1 - left[0][0]},Other\n")
    run(site, "pseudolabel", "--cells", "@cells", "--names", "@n.csv", "--site", "s", "--out", "@maps")
    run(site, "pseudolabel", "--cells", "@cells", "--names", "@n.csv", "--site", "s", "--out", "@maps")
    assert spark.read.parquet(f"{site}/maps").count() == 4
    assert json.loads((site / "maps_mapping.json").read_text())["cluster_to_class_id"] == {str(left[0][0]): 6, str(1 - left[0][0]): 7}
    run(site, "train", "--features", "@features", "--maps", "@maps", "--site", "s", "--out", "@model.json")
    run(site, "infer", "--ortho", "@o/a.tif", "--model", "@model.json", "--out", "@pred.tif")
    got = tiff.Reader((site / "pred.tif").read_bytes()).read()[0]
    assert (got[:, : SIDE // 2] == 6).all() and (got[:, SIDE // 2 :] == 7).all()


def test_candidates_propagation_and_rasterizing(spark, site, capsys):
    seeds = {"Sphagnum": [(box(10, 10, 30, 30), {})], "Other": [(box(200, 10, 220, 30), {})]}
    (site / "seeds.gpkg").write_bytes(gpkg.encode(seeds))
    run(site, "ingest", "--source", "@seeds.gpkg", "--site", "s", "--polygons", "@polygons")
    run(site, "ingest", "--source", "@seeds.gpkg", "--site", "s", "--polygons", "@polygons")
    assert gpkg.load(spark, f"{site}/polygons").count() == 2
    run(site, "candidates", "--tiles", "@tiles", "--features", "@features", "--cells", "@cells", "--site", "s", "--out", "@cand")
    found = spark.read.parquet(f"{site}/cand")
    assert sorted((r["x0"], r["area"]) for r in found.collect()) == [(500000.0, 19600.0)] * 2 + [(500140.0, 19600.0)] * 2
    args = ("--polygons", "@polygons", "--candidates", "@cand", "--tiles", "@tiles", "--features", "@features", "--site", "s", "--species", "Sphagnum")
    run(site, "propagate", *args)
    layer = gpkg.load(spark, f"{site}/polygons")
    auto = layer.filter("source = 'auto'").collect()
    assert {(r["species"], r["x0"], r["y1"]) for r in auto} == {("Sphagnum", 500000.0, 4000000.0), ("Sphagnum", 500000.0, 3999860.0)}
    run(site, "propagate", *args)
    assert layer.count() == 4  # a second run adds nothing
    run(site, "rasterize", "--polygons", "@polygons", "--site", "s", "--ortho", "@o/a.tif", "--out", "@label.tif")
    r = tiff.Reader((site / "label.tif").read_bytes())
    a = r.read()[0]
    assert (a[:, :140] == 6).all() and (a[10:30, 200:220] == 7).all() and (a == 255).sum() == 140 * 280 - 400 and r.nodata == 255
    run(site, "validate", "--truth", "@label.tif", "--pred", "@pred.tif")
    out = capsys.readouterr().out
    assert "|6  |Sphagnum|39200|39200|1.0|" in out and "|7  |Other   |400  |400  |1.0|" in out
    with pytest.raises(ValueError, match="Poa"):
        run(site, "propagate", *args[:-1], "Poa_costiniana")


def test_import_and_export(spark, site):
    theirs = {"x": [(box(100, 100, 120, 120), {"species": "P. costiniana"}), (box(150, 150, 170, 170), {"species": "Bog moss"}), (box(900, 900, 920, 920), {"species": "Other"})]}
    (site / "theirs.gpkg").write_bytes(gpkg.encode(theirs))
    args = ("--source", "@theirs.gpkg", "--polygons", "@polygons", "--site", "s", "--ortho", "@o/a.tif", "--map", "bog moss=Sphagnum")
    nesp = lambda: sorted(r["species"] for r in gpkg.load(spark, f"{site}/polygons").filter("source = 'nesp'").collect())
    run(site, "import", *args, "--dry-run")
    assert nesp() == []
    run(site, "import", *args)
    run(site, "import", *args)
    assert nesp() == ["Poa_costiniana", "Sphagnum"]
    target = {"t": [(box(200, 10, 220, 30), {"id": 41, "Species": "Other"}), (box(700, 700, 720, 720), {"id": 3, "Species": "Bog moss"}), (box(740, 700, 760, 720), {"id": 4, "Species": "Sphagnum"})]}
    (site / "target.gpkg").write_bytes(gpkg.encode(target, fields=gpkg.TARGET_FIELDS))
    args = ("--polygons", "@polygons", "--site", "s", "--to", "@target.gpkg", "--out", "@sent", "--log", "@log", "--map", "bog moss=Sphagnum")
    run(site, "export", *args)
    sent = spark.read.parquet(f"{site}/sent")
    assert sorted((r["new_id"], r["species"]) for r in sent.collect()) == [(42, "Sphagnum"), (43, "Sphagnum"), (44, "Sphagnum")]
    assert {r["their_name"] for r in sent.collect()} == {"Bog moss"}  # as the receiver spells it first
    run(site, "export", *args)
    assert sent.count() == 3  # the log remembers
    run(site, "export", *(x.replace("target", "fresh").replace("@sent", "@sent2").replace("@log", "@log2") for x in args[:-2]))
    assert {r["their_name"] for r in spark.read.parquet(f"{site}/sent2").collect()} == {"Sphagnum", "Other"} and gpkg.read_polygons(spark, f"{site}/fresh.gpkg").count() == 0


def test_prepare_and_mosaic(spark, site):
    run(site, "mosaic", "--tiles", "@tiles", "--site", "s", "--out", "@m.tif")
    m, o = (tiff.Reader((site / n).read_bytes()) for n in ("m.tif", "o/a.tif"))
    assert (m.read()[0] == o.read()[0]).all() and (m.transform, m.epsg) == (o.transform, o.epsg)
    run(site, "prepare", "--ortho", "@o/a.tif", "--out", "@p.tif")
    at = (site / "p.tif").stat().st_mtime_ns
    p = tiff.Reader((site / "p.tif").read_bytes())
    assert (p.width, p.height, p.transform[0]) == (140, 140, 2.0) and (p.read()[0][:, :69] == 200).all()
    run(site, "prepare", "--ortho", "@o/a.tif", "--out", "@p.tif")
    assert (site / "p.tif").stat().st_mtime_ns == at


def test_layers_count_and_clean(spark, site, capsys):
    run(site, "layers", "--source", "@seeds.gpkg")
    run(site, "clean", "--polygons", "@polygons", "--site", "s")
    run(site, "count", "--polygons", "@polygons")
    assert "|Sphagnum|1" in capsys.readouterr().out
    assert gpkg.load(spark, f"{site}/polygons").filter(F.col("source") == "auto").isEmpty()


def test_deleting_leaves_other_files_alone(spark, tmp_path):
    path = str(tmp_path / "p")
    for name in ("a", "b"):
        rows = [(name, i, b"x", "Other" if i % 2 else "Sphagnum", "auto" if i < 4 else None) for i in range(6)] + [(name, 9, b"x", "Poa_costiniana", "auto")]
        gpkg.append(spark.createDataFrame(rows, "site string, fid long, wkb binary, species string, source string"), path)
    files = lambda site, *species: sorted(str(f) for s in species for f in (tmp_path / "p" / f"site={site}" / f"species={s}").glob("*.parquet"))
    before = files("b", "Other", "Sphagnum", "Poa_costiniana")
    assert gpkg.delete(spark, path, (F.col("site") == "a") & (F.col("source") == "auto")) == 5
    assert files("b", "Other", "Sphagnum", "Poa_costiniana") == before and files("a", "Poa_costiniana") == []
    assert sorted((r["site"], r["fid"]) for r in gpkg.load(spark, path).collect()) == [("a", 4), ("a", 5)] + [("b", i) for i in (0, 1, 2, 3, 4, 5, 9)]
    kept = files("a", "Other")
    assert gpkg.delete(spark, path, (F.col("site") == "a") & (F.col("species") == "Sphagnum")) == 1 and files("a", "Other") == kept
    assert gpkg.delete(spark, path, F.lit(False)) == 0


def test_a_batch_goes_on_after_a_failure(spark, site, capsys):
    (site / "sites.csv").write_text(f"# name,path\nnone,{site}/missing.tif\ngood,{site}/o/a.tif\n")
    with pytest.raises(SystemExit, match="1 sites failed: none"):
        run(site, "batch", "--manifest", "@sites.csv", "--out", "@batch")
    assert {r["site"] for r in spark.read.parquet(f"{site}/batch/features").select("site").distinct().collect()} == {"good"}
    assert json.loads((site / "batch/good/site.json").read_text()) == {"site": "good", "ortho": f"{site}/o/a.tif"}
    run(site, "rasterize", "--polygons", "@polygons", "--site", "s", "--record", "@batch/good/site.json", "--out", "@again.tif")
    assert (site / "again.tif").exists()


def test_settings_from_a_nested_file(tmp_path):
    from fieldloom.config import Settings, read_settings

    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("classes:\n  0: None\n  1: Moss\ntiling:\n  tile_size: 256\npropagate:\n  match:\n    max_area_m2: 7.5\n  prototype:\n    seed_sources: [seed, null]\n")
    s = read_settings(str(tmp_path / "c.yaml"))
    assert (s.classes, s.tile_size, s.max_area, s.seed_sources, s.overlap) == ({0: "None", 1: "Moss"}, 256, 7.5, ("seed", None), 64)
    assert read_settings(None) == Settings() and (Settings().min_area, Settings().max_area) == (0.05, 500.0)
