"""Command line: python -m fieldloom COMMAND --help."""

from __future__ import annotations

import argparse
import dataclasses
import datetime
import json
import os
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fieldloom.config import Settings, read_settings, resolve
from fieldloom.functions import grid
from fieldloom.operators import spatial


def _session() -> SparkSession:
    return SparkSession.builder.appName("fieldloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _replace(df, out: str, site: str) -> None:
    """Write a site's rows in place of those of an earlier run; other sites stay."""
    df.withColumn("site", F.lit(site)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("site").parquet(out)


def _existing(spark, path: str):
    """A table, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None


def _print(df) -> None:
    """All rows of a report: one per class, layer or site."""
    df.show(max(1, df.count()), False)


def tile(a, s: Settings) -> None:
    from fieldloom.sources import tiff

    rows = tiff.read_tiles(_session(), a.ortho, s.tile_size, s.overlap, s.min_valid)
    _replace(rows, a.out, a.site)


def features(a, s: Settings) -> None:
    from fieldloom.operators import models

    spark = _session()
    tiles, done = spark.read.parquet(a.tiles).filter(F.col("site") == a.site), _existing(spark, a.out)
    if done is not None:  # tiles that an earlier run finished are left out
        done = done.filter(F.col("site") == a.site).select("stem").distinct()
    models.extract_features(tiles, s.tile_size, done=done).withColumn("site", F.lit(a.site)).write.mode("append").partitionBy("site").parquet(a.out)


def cluster(a, s: Settings) -> None:
    from fieldloom.operators import vectors

    spark = _session()
    p = spark.read.parquet(a.features).filter(F.col("site") == a.site).withColumn("pid", F.struct("stem", "pr", "pc"))
    centres = vectors.fit_kmeans(p, "pid", "feat", s.clusters, s.sample_fraction, seed=s.seed)
    cells = vectors.assign_centroids(p, centres, "pid", "feat", "cluster_id", "centre").select("pid.*", "cluster_id")
    _replace(cells, a.out, a.site)


def montage(a, s: Settings) -> None:
    from fieldloom.operators import sampling

    cells = _session().read.parquet(a.cells).filter(F.col("site") == a.site)
    sampling.montage_sample(cells, seed=s.seed).write.mode("overwrite").parquet(a.out)
    sampling.name_template(cells).write.mode("overwrite").csv(f"{a.out}_names", header=True)


def pseudolabel(a, s: Settings) -> None:
    from fieldloom.operators import models, sampling

    spark = _session()
    classes = spark.createDataFrame(sorted(s.classes.items()), "class_id int, name string")
    mapping = sampling.cluster_classes(sampling.read_names(spark, a.names), classes)
    maps = models.pseudolabels(models.cluster_map(spark.read.parquet(a.cells).filter(F.col("site") == a.site), s.tile_size, s.tile_size // 14), mapping)
    _replace(maps, a.out, a.site)
    with open(f"{a.out.removeprefix('file:').rstrip('/')}_mapping.json", "w") as f:
        json.dump({"cluster_to_class_id": mapping, "class_id_to_name": s.classes}, f, indent=2)
    _print(models.byte_counts(spark.read.parquet(a.out).filter(F.col("site") == a.site).select("stem", "data")).orderBy("cls"))


def init(a, s: Settings) -> None:
    from fieldloom.sources import gpkg

    gpkg.init_layers(_session(), a.polygons, a.site, a.force)


def ingest(a, s: Settings) -> None:
    from fieldloom.sources import gpkg, tables

    rows = gpkg.read_polygons(_session(), a.source)
    flat = rows.select(F.lit(a.site).alias("site"), "layer", "fid", "wkb", F.col("area").alias("geom_area"), "x0", "y0", "x1", "y1", *[F.col("attrs")[n].cast(t).alias(n) for n, t in gpkg.FIELDS])
    old = _existing(_session(), a.polygons)
    if old is not None:  # what a former run took in stays as it is
        key = [F.xxhash64("wkb"), F.coalesce(F.nullif(F.trim("species"), F.lit("")), F.lit(""))]
        flat = gpkg.conform(flat.withColumn("species", F.coalesce(F.nullif(F.trim("species"), F.lit("")), F.col("layer"))).drop("layer"))
        seen = gpkg.load(_session(), a.polygons).filter(F.col("site") == a.site).select(key[0].alias("o_key"), key[1].alias("o_species")).distinct()
        flat = tables.Scratch(_session()).save(flat.join(seen, (key[0] == F.col("o_key")) & (key[1] == F.col("o_species")), "left_anti"))
    gpkg.append(flat, a.polygons)


def count(a, s: Settings) -> None:
    from fieldloom.sources import gpkg

    auto = F.col("source").eqNullSafe("auto")
    rows = gpkg.load(_session(), a.polygons).groupBy("site", "species")
    _print(rows.agg(F.count("*").alias("total"), F.count_if(~auto).alias("hand"), F.count_if(auto).alias("auto")).orderBy("site", "species"))


def clean(a, s: Settings) -> None:
    from fieldloom.sources import gpkg

    where = F.col("site") == a.site
    if a.species:
        where &= F.col("species") == a.species
    if not a.all:
        where &= F.col("source").eqNullSafe("auto")
    print(gpkg.delete(_session(), a.polygons, where, a.backup))


# --- rasters -----------------------------------------------------------------------------------------------


def _reader(path: str):
    from fieldloom.sources import tiff

    return tiff.Reader(tiff.Ranges(path if ":" in path else f"file:{os.path.abspath(path)}"))


def _write(blocks, out: str, width: int, height: int, block: int, bands: int, dtype: str, like, nodata=None) -> None:
    from fieldloom.sources import tables, tiff

    tiff.write_blocks(blocks, out, tables.Scratch(blocks.sparkSession), width, height, block, bands, dtype, like[0], like[1], nodata)


def prepare(a, s: Settings) -> None:
    """Nothing is done where the result of the same file and resolution is there already."""
    from fieldloom.operators import models

    made_of = {"path": os.path.abspath(a.ortho), "size": os.path.getsize(a.ortho), "mtime": os.path.getmtime(a.ortho), "resolution": s.resolution}
    note = f"{a.out}.json"
    if not a.force and os.path.exists(a.out) and os.path.exists(note) and json.load(open(note)) == made_of:
        return
    r = _reader(a.ortho)
    epsg, target, width, height, back = models.target_grid(r, s.resolution)
    if grid.resolution_note(own := models.pixel_size(r), s.resolution) == "coarser":
        print(f"pixels of {own:.4f} m are coarser than the {s.resolution} m asked for and stay")
    blocks = models.warp(_session(), f"file:{made_of['path']}", target, width, height, back)
    _write(blocks, a.out, width, height, 512, r.bands, r.dtype.newbyteorder("=").str, (target, epsg), r.nodata)
    with open(note, "w") as f:
        json.dump(made_of, f)


def mosaic(a, s: Settings) -> None:
    from fieldloom.sources import tiff

    tiles = _session().read.parquet(a.tiles).filter(F.col("site") == a.site)
    first = tiles.orderBy("row_idx", "col_idx").first()
    if first is None:
        raise ValueError(f"site {a.site} has no tiles")
    height, width = tiles.agg(F.max(F.col("row_off") + F.col("actual_h")), F.max(F.col("col_off") + F.col("actual_w"))).first()
    p, q, r, t, u, v = first["transform"]
    at = (p, q, r - p * first["col_off"] - q * first["row_off"], t, u, v - t * first["col_off"] - u * first["row_off"])
    _write(tiff.mosaic(tiles, width, height, s.tile_size, s.overlap, int(a.band)), a.out, width, height, 512, 1, first["dtype"], (at, first["epsg"]))


def rasterize(a, s: Settings) -> None:
    from fieldloom.operators import lookup, polygons

    spark, r = _session(), _reader(a.ortho)
    classes = spark.createDataFrame(s.named(), "class_id int, c_name string")
    rows = _layer(spark, a).join(F.broadcast(classes), F.col("species") == F.col("c_name"))
    rows = rows.withColumn("band", F.when(lookup.is_seed(F.col("source"), lookup.MANUAL), 2.0).otherwise(1.0))
    blocks = polygons.burn(rows, r.width, r.height, r.transform, "class_id", "band", "class_id")
    _write(blocks, a.out, r.width, r.height, 256, 1, "u1", (r.transform, r.epsg), 255)


# --- candidates and propagation ----------------------------------------------------------------------------


def _layer(spark, a):
    from fieldloom.sources import gpkg

    # the drawing tool's own area goes: column names don't tell capitals apart
    return gpkg.load(spark, a.polygons).filter(F.col("site") == a.site).drop("Area").withColumnRenamed("geom_area", "area")


def _tiles_and_patches(spark, a, s: Settings):
    """Tiles and patches under one number per tile, and the number of tiles in a row."""
    tiles = spark.read.parquet(a.tiles).filter(F.col("site") == a.site)
    across = (tiles.agg(F.max("col_idx")).first()[0] or 0) + 1
    number = F.col("row_idx").cast("long") * across + F.col("col_idx")
    t = F.col("transform")
    xs, ys = ([F.least(k, k + t[i] * s.tile_size), F.greatest(k, k + t[i] * s.tile_size)] for i, k in ((0, t[2]), (4, t[5])))
    tiles = tiles.select(number.alias("tile_idx"), "transform", F.lit(s.tile_size).alias("size"), xs[0].alias("x0"), ys[0].alias("y0"), xs[1].alias("x1"), ys[1].alias("y1"))
    patches = spark.read.parquet(a.features).filter(F.col("site") == a.site).select(number.alias("tile_idx"), "pr", "pc", "feat")
    return tiles, patches, across


def _cell(tiles) -> float:
    """The cell of the joins by boxes: a tile's side."""
    return float(tiles.agg(F.max(F.col("x1") - F.col("x0"))).first()[0] or 1.0)


def candidates(a, s: Settings) -> None:
    """Candidates are the polygons of a vector file, or else the connected regions of equal clusters in each tile."""
    from fieldloom.operators import polygons, propagate
    from fieldloom.sources import gpkg, tables

    spark = _session()
    tiles, patches, across = _tiles_and_patches(spark, a, s)
    per = s.tile_size // 14
    if a.vector:
        shapes = gpkg.read_polygons(spark, a.vector)
    else:
        cells = spark.read.parquet(a.cells).filter(F.col("site") == a.site)
        r, c = grid.tile_of_name(F.col("stem"))
        high = (r.cast("long") * across + c) * (per + 1)  # tiles lie below one another with a gap, so that no region leaves its tile
        found = polygons.polygonize(cells.select((high + F.col("pr")).alias("y"), F.col("pc").cast("long").alias("x"), "cluster_id"), "cluster_id", tables.Scratch(spark))
        found = found.withColumn("t_idx", F.floor(F.col("y0") / (per + 1)))
        found = found.join(tiles.select("tile_idx", "transform"), F.col("t_idx") == F.col("tile_idx"))
        up = s.tile_size / per
        t, top = F.col("transform"), F.col("t_idx") * (per + 1)
        affine = F.array(t[0] * up, t[1] * up, t[2] - t[1] * up * top, t[3] * up, t[4] * up, t[5] - t[4] * up * top)
        pixel = F.abs(t[0] * t[4] - t[1] * t[3])
        placed = found.select(polygons.st_affine(F.col("wkb"), affine).alias("wkb"), pixel.alias("pixel"))
        shapes = polygons.with_bounds(placed).withColumn("area", polygons.st_area("wkb")).filter(F.col("area") >= F.col("pixel") * float(a.min_px))
    shapes = tables.Scratch(spark).save(shapes.select(F.xxhash64("wkb").alias("cid"), "wkb", "area", *spatial.BOX).dropDuplicates(["cid"]))
    out = propagate.candidate_library(shapes, "cid", tiles, patches, per, _cell(tiles), s)
    out.withColumn("site", F.lit(a.site)).write.mode("overwrite").partitionBy("site").option("partitionOverwriteMode", "dynamic").parquet(a.out)


def propagate(a, s: Settings) -> None:
    """Candidates like the seeds of a species, and unlike those of the others, are added to the site's polygons."""
    from functools import reduce

    from fieldloom.operators import propagate as p
    from fieldloom.operators import vectors
    from fieldloom.sources import gpkg, tables

    spark = _session()
    s = dataclasses.replace(s, **{k: float(v) for k in ("threshold", "margin") if (v := getattr(a, k)) is not None})
    tiles, patches, _ = _tiles_and_patches(spark, a, s)
    layer, cell, per = tables.Scratch(spark).save(_layer(spark, a)), _cell(tiles), s.tile_size // 14
    layer = layer.withColumn("sid", F.xxhash64("wkb"))
    protos = []
    for _, name in s.named():  # a few classes
        seeds = p.seeds_of(layer, name, s)
        if seeds.isEmpty():
            continue
        try:
            protos.append(p.prototype_of(seeds, "sid", tiles, patches, per, cell, s).withColumn("species", F.lit(name)))
        except ValueError:
            if name == a.species:
                raise
    rows = tables.Scratch(spark).save(reduce(lambda x, y: x.unionByName(y), protos)) if protos else None
    if rows is None or rows.filter(F.col("species") == a.species).isEmpty():
        raise ValueError(f"no seeds of {a.species}")
    found = spark.read.parquet(a.candidates).filter(F.col("site") == a.site).drop("site")
    stamp = datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")
    new, scored = p.propagate(found, "cid", layer, rows, a.species, stamp, cell, s)
    new = tables.Scratch(spark).save(new)
    _print(vectors.histogram(scored, "sim_x").orderBy("bin"))
    print(f"{new.count()} new polygons of {a.species}")
    gpkg.append(new.withColumn("site", F.lit(a.site)).withColumnRenamed("cid", "fid"), a.polygons)


# --- exchange ----------------------------------------------------------------------------------------------


def import_labels(a, s: Settings) -> None:
    from fieldloom.functions import names
    from fieldloom.operators import exchange, lookup
    from fieldloom.sources import gpkg, tables

    spark, scratch = _session(), tables.Scratch(_session())
    known = [n for _, n in s.named()]
    classes = spark.createDataFrame([(n,) for n in known], "name string")
    r = _reader(a.ortho)
    corners = [(r.transform[2] + r.transform[0] * u, r.transform[5] + r.transform[4] * v) for u, v in ((0, 0), (r.width, r.height))]
    box = (min(x for x, _ in corners), min(y for _, y in corners), max(x for x, _ in corners), max(y for _, y in corners))
    everything = scratch.save(gpkg.read_polygons(spark, a.source))
    for file in [x[0] for x in everything.select("path").distinct().orderBy("path").collect()]:  # the files that a person named
        rows = everything.filter(F.col("path") == file)
        field = a.field
        if not field:
            fields = [x[0] for x in rows.select(F.explode(F.map_keys("attrs")).alias("k")).distinct().orderBy("k").collect()]  # a table's columns
            spelt = known + [x[0] for x in classes.select(names.abbreviated(F.col("name"))).collect()]
            field = lookup.guess_field(rows.select(*[F.col("attrs")[f].alias(f) for f in fields]), fields, spelt).first()["field"] if fields else None
            if field is None:
                raise ValueError(f"{file}: no column has known names; use --field")
        stem = os.path.splitext(os.path.basename(file))[0]
        existing = scratch.save(_layer(spark, a))
        new, report = exchange.import_rows(rows, existing, classes, field, stem, box, names.overrides(a.map or [], set(known)), float(a.min_inside), float(a.dup_iou), max(box[2] - box[0], box[3] - box[1], 1e-6) / 256, scratch)
        _print(report)
        if not a.dry_run:
            gpkg.append(new.withColumn("site", F.lit(a.site)).withColumn("source", F.lit("nesp")).withColumn("fid", F.xxhash64("lb_note")), a.polygons)


def export_labels(a, s: Settings) -> None:
    """The rows to send, with their new ids and in the receiver's spelling, are added to a table, and then to the log of what was sent."""
    from fieldloom.functions import names
    from fieldloom.operators import exchange, lookup
    from fieldloom.sources import gpkg, tables

    spark, scratch = _session(), tables.Scratch(_session())
    local = a.to.removeprefix("file:")
    if not os.path.exists(local) and a.to.endswith(".gpkg") and not a.dry_run:
        with open(local, "wb") as f:  # a fresh file with the receiver's columns
            f.write(gpkg.encode({os.path.splitext(os.path.basename(local))[0]: []}, fields=gpkg.TARGET_FIELDS))
    there = scratch.save(gpkg.read_polygons(spark, a.to))
    target = there.select(F.col("attrs")[a.id_field].try_cast("long").alias("id"), "wkb", "area", *spatial.BOX)
    classes = spark.createDataFrame(s.named(), "class_id int, name string")
    given = names.overrides(a.map or [], {n for _, n in s.named()})
    spelt = there.select("layer", "fid", "part", F.col("attrs")[a.name_field].alias("theirs")).filter("theirs is not null")
    learned = {r["species"]: r["spelling"] for r in lookup.learned_spelling(spelt, "theirs", ["layer", "fid", "part"], classes, given).collect()}  # one row per class
    rows = _layer(spark, a).withColumn("layer", F.col("species")).withColumn("part", F.lit(0))
    log = spark.createDataFrame([], "layer string, fid long, site string")
    try:
        log = scratch.save(spark.read.schema("layer string, fid long, site string").parquet(a.log))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    sides = rows.agg(F.avg(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))).first()[0]
    send, counts = exchange.export_rows(rows, target, log.filter(F.col("site") == a.site), float(sides or 1.0), scratch, float(a.dedup_iou), a.include_imported, a.species, a.all, int(a.width) if a.width else None, learned, {ours: theirs for theirs, ours in reversed(given.items())})
    _print(counts.orderBy("layer"))
    if not a.dry_run:
        send = scratch.save(send.withColumn("site", F.lit(a.site)))
        send.write.mode("append").parquet(a.out)
        send.select("layer", "fid", "site").write.mode("append").parquet(a.log)


# --- models ------------------------------------------------------------------------------------------------


def train(a, s: Settings) -> None:
    from fieldloom.operators import models

    spark = _session()
    f, m = (spark.read.parquet(x).filter(F.col("site") == a.site) for x in (a.features, a.maps))
    fitted = models.PatchTrainer().fit(models.labelled_patches(f, m, s.tile_size, s.tile_size // 14))
    with open(a.out, "w") as out:
        json.dump({"coef": fitted.coefficientMatrix.toArray().tolist(), "intercept": fitted.interceptVector.toArray().tolist()}, out)


def infer(a, s: Settings) -> None:
    import numpy as np

    from fieldloom.operators import models
    from fieldloom.sources import tiff

    r, given = _reader(a.ortho), json.load(open(a.model))
    coef, intercept = np.array(given["coef"]), np.array(given["intercept"])
    total = max(len(intercept), max(s.classes) + 1)
    make = models.patch_logits(coef, intercept, list(range(len(intercept))), total)
    tiles = tiff.read_tiles(_session(), a.ortho, s.tile_size, s.overlap, 0.0)
    _write(models.infer(tiles, r.width, r.height, s.tile_size, s.overlap, total, make), a.out, r.width, r.height, 256, 1, "u1", (r.transform, r.epsg), 255)


def validate(a, s: Settings) -> None:
    """Class IoUs of two class rasters of one grid; pixels without truth don't count."""
    from fieldloom.operators import metrics, models
    from fieldloom.sources import tiff

    spark = _session()
    sides = [tiff.read_tiles(spark, x, 512, 0, 0.0, pad=False).select("row_idx", "col_idx", "data").withColumnRenamed("data", n) for x, n in ((a.truth, "truth"), (a.pred, "pred"))]
    per = metrics.iou_of_counts(models.confusion(sides[0].join(sides[1], ["row_idx", "col_idx"]))).filter(F.col("cls") != 255)
    classes = spark.createDataFrame(sorted(s.classes.items()), "class_id int, name string")
    _print(per.join(F.broadcast(classes), F.col("cls") == F.col("class_id"), "left").select("cls", "name", "inter", "uni", "iou").orderBy("cls"))
    _print(metrics.mean_iou(per))


def batch(a, s: Settings) -> None:
    """Tiles and features of every site of a manifest; one that fails doesn't stop the others, and all failures are told in the end."""
    from fieldloom.config import upsert_record
    from fieldloom.operators import sampling

    failed = {}
    for row in sampling.read_manifest(_session(), a.manifest).collect():  # a few lines that a person wrote
        folder = os.path.join(a.out, row["site"])
        try:
            one = argparse.Namespace(site=row["site"], ortho=row["path"], tiles=os.path.join(a.out, "tiles"), out=os.path.join(a.out, "tiles"))
            tile(one, s)
            one.out = os.path.join(a.out, "features")
            features(one, s)
            os.makedirs(folder, exist_ok=True)
            note = os.path.join(folder, "site.json")
            old = open(note).read() if os.path.exists(note) else None
            with open(note, "w") as f:
                f.write(upsert_record(old, {"site": row["site"], "ortho": row["path"]}))
            print(f"{row['site']}: done")
        except Exception as e:  # noqa: BLE001
            failed[row["site"]] = str(e).splitlines()[0] if str(e) else type(e).__name__
            print(f"{row['site']}: failed, {failed[row['site']]}")
    if failed:
        raise SystemExit(f"{len(failed)} sites failed: {', '.join(sorted(failed))}")


def layers(a, s: Settings) -> None:
    from fieldloom.sources import gpkg

    _print(gpkg.list_layers(_session(), a.source).orderBy("path", "layer"))


#: Each command's function, its required options, its further options with their defaults (False makes a switch).
COMMANDS = {
    "tile": (tile, ("ortho", "site", "out"), {}), "features": (features, ("tiles", "site", "out"), {}), "cluster": (cluster, ("features", "site", "out"), {}),
    "montage": (montage, ("cells", "site", "out"), {}), "pseudolabel": (pseudolabel, ("cells", "names", "site", "out"), {}),
    "init": (init, ("polygons", "site"), {"force": False}), "ingest": (ingest, ("source", "site", "polygons"), {}), "count": (count, ("polygons",), {}),
    "clean": (clean, ("polygons", "site"), {"species": None, "all": False, "backup": None}), "layers": (layers, ("source",), {}),
    "prepare": (prepare, ("ortho", "out"), {"force": False}), "mosaic": (mosaic, ("tiles", "site", "out"), {"band": "0"}),
    "rasterize": (rasterize, ("polygons", "site", "out"), {"ortho": None, "record": None}), "batch": (batch, ("manifest", "out"), {}),
    "candidates": (candidates, ("tiles", "features", "site", "out"), {"cells": None, "vector": None, "min_px": "0"}),
    "propagate": (propagate, ("polygons", "candidates", "tiles", "features", "site", "species"), {"threshold": None, "margin": None}),
    "import": (import_labels, ("source", "polygons", "site"), {"ortho": None, "record": None, "field": None, "map": [], "min_inside": "0.5", "dup_iou": "0.95", "dry_run": False}),
    "export": (export_labels, ("polygons", "site", "to", "out", "log"), {"id_field": "id", "name_field": "Species", "map": [], "species": None, "include_imported": False, "all": False, "dedup_iou": "0.9", "width": None, "dry_run": False}),
    "train": (train, ("features", "maps", "site", "out"), {}), "infer": (infer, ("ortho", "model", "out"), {}), "validate": (validate, ("truth", "pred"), {}),
}


def main(argv: list[str]) -> int:
    top = argparse.ArgumentParser(prog="fieldloom")
    subs = top.add_subparsers(dest="command", required=True)
    for name, (run, needed, more) in COMMANDS.items():
        p = subs.add_parser(name, description=run.__doc__)
        p.add_argument("--config", help="a JSON or YAML file of settings")
        for x in needed:
            p.add_argument(f"--{x}", required=True)
        for x, default in more.items():
            kind = {"action": "store_true"} if default is False else {"action": "append"} if default == [] else {"default": default}
            p.add_argument(f"--{x.replace('_', '-')}", **kind)
    a = top.parse_args(argv)
    if "record" in a:  # the raster that was given, else the one that the site's record names
        a.ortho = resolve(a.ortho, json.load(open(a.record)).get("ortho") if a.record else None)
    COMMANDS[a.command][0](a, read_settings(a.config))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
