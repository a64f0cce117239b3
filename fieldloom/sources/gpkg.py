"""GeoPackage layers through sqlite3: listing, scanning, writing, and the polygon table that replaces them at rest."""

from __future__ import annotations

import os
import sqlite3
import tempfile
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions import geometry

#: Attributes of a species layer, in order (fixed format).
FIELDS = (
    ("lb_name", "string"), ("lb_note", "string"), ("group_ulid", "string"), ("N_GM", "int"), ("id", "int"), ("Area", "double"), ("N_FG", "int"),
    ("N_BG", "int"), ("BBox", "string"), ("species", "string"), ("source", "string"), ("score", "double"), ("run_ts", "string"),
)
#: Attributes of a file that labels are handed over in (fixed format).
TARGET_FIELDS = (("id", "int"), ("Review", "string"), ("Comments", "string"), ("Species", "string"))
POLYGONS = "path string, layer string, fid long, part int, wkb binary, area double, x0 double, y0 double, x1 double, y1 double, attrs map<string,string>"


def _connect(blob: bytes) -> sqlite3.Connection:
    db = sqlite3.connect(":memory:")
    db.deserialize(blob)
    return db


def _layers(db: sqlite3.Connection) -> list[tuple[str, str]]:
    """(table, geometry column) of the feature tables; attribute-only tables are left out."""
    q = "SELECT c.table_name, g.column_name FROM gpkg_contents c JOIN gpkg_geometry_columns g USING (table_name) WHERE c.data_type = 'features' ORDER BY c.table_name"
    return db.execute(q).fetchall()


def _rows(db: sqlite3.Connection, table: str, column: str) -> Iterable[tuple[int, list, dict[str, str]]]:
    names = [r[1] for r in db.execute(f'PRAGMA table_info("{table}")')]
    key = next((r[1] for r in db.execute(f'PRAGMA table_info("{table}")') if r[5]), "rowid")
    for row in db.execute(f'SELECT "{key}", * FROM "{table}" ORDER BY 1'):
        attrs = dict(zip(names, row[1:]))
        blob = attrs.pop(column)
        attrs.pop(key, None)
        if blob:
            yield row[0], geometry.read_wkb(geometry.blob_to_wkb(bytes(blob))), {k: str(v) for k, v in attrs.items() if v is not None}


def read_polygons(spark: SparkSession, path: str, layers: list[str] | None = None) -> DataFrame:
    """Every polygon of every layer under a path, multipolygons and self-crossing rings parted; null, empty and flat geometries go.

    ``part`` counts the kept parts of a feature from 0. Attributes stay a map, as layers differ.
    """

    def scan(frames):
        import pandas as pd

        names = [x.split()[0] for x in POLYGONS.split(", ")]
        for frame in frames:
            for file, blob in zip(frame["path"], frame["content"]):
                db = _connect(bytes(blob))
                for table, column in _layers(db):
                    if layers is not None and table not in layers:
                        continue
                    out = []
                    for fid, polygons, attrs in _rows(db, table, column):
                        good = [v for p in polygons for v in geometry.made_valid(p) if geometry.area(v) > 0]
                        out += [(file, table, fid, k, geometry.write_wkb(p), geometry.area(p), *geometry.bounds(p), attrs) for k, p in enumerate(good)]
                    yield pd.DataFrame(out, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gpkg").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(scan, POLYGONS)


def list_layers(spark: SparkSession, path: str) -> DataFrame:
    """(path, layer, n) of the feature layers under a path."""

    def scan(frames):
        import pandas as pd

        for frame in frames:
            out = []
            for file, blob in zip(frame["path"], frame["content"]):
                db = _connect(bytes(blob))
                out += [(file, t, db.execute(f'SELECT count(*) FROM "{t}"').fetchone()[0]) for t, _ in _layers(db)]
            yield pd.DataFrame(out, columns=["path", "layer", "n"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gpkg").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(scan, "path string, layer string, n long")


def encode(layers: dict[str, list[tuple[geometry.Polygon, dict]]], srs_id: int = 32755, fields: tuple = FIELDS) -> bytes:
    """A GeoPackage with one table per layer; unset attributes stay null and empty geometries are skipped."""
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "x.gpkg")
        db = sqlite3.connect(path)
        db.executescript(
            """PRAGMA application_id = 1196444487; PRAGMA user_version = 10300;
            CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
            CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT, description TEXT, last_change TEXT, min_x REAL, min_y REAL, max_x REAL, max_y REAL, srs_id INTEGER);
            CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);"""
        )
        db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, 'EPSG', ?, 'undefined', NULL)", (f"EPSG:{srs_id}", srs_id, srs_id))
        kinds = {"string": "TEXT", "int": "INTEGER", "double": "REAL"}
        for layer, rows in layers.items():
            db.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY, geom BLOB, {", ".join(f"{chr(34)}{n}{chr(34)} {kinds[t]}" for n, t in fields)})')
            db.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, ?)", (layer, layer, srs_id))
            db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'POLYGON', ?, 0, 0)", (layer, srs_id))
            for p, attrs in rows:
                if p:
                    names = [n for n, _ in fields if attrs.get(n) is not None]
                    marks = ", ".join("?" * (len(names) + 1))
                    cols = ", ".join(["geom", *(f'"{n}"' for n in names)])
                    db.execute(f'INSERT INTO "{layer}" ({cols}) VALUES ({marks})', [geometry.wkb_to_blob(geometry.write_wkb(p), srs_id), *(attrs[n] for n in names)])
        db.commit()
        db.close()
        with open(path, "rb") as f:
            return f.read()


# --- the polygon table at rest -----------------------------------------------------------------------------

#: ``geom_area`` is worked out from the geometry, ``Area`` is whatever the drawing tool entered.
SCHEMA = T.StructType(
    [T.StructField("site", T.StringType()), T.StructField("fid", T.LongType()), T.StructField("wkb", T.BinaryType()), T.StructField("geom_area", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in ("x0", "y0", "x1", "y1")]
    + [T.StructField(n, {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType()}[t]) for n, t in FIELDS]
)


def conform(df: DataFrame) -> DataFrame:
    """Missing columns are added as null, and a blank species is stamped with its layer if there is one."""
    empty = df.sparkSession.createDataFrame([], SCHEMA)
    out = empty.unionByName(df, allowMissingColumns=True)
    return out.withColumn("species", F.when(F.trim(F.coalesce("species", F.lit(""))) == "", F.col("layer") if "layer" in df.columns else F.lit(None)).otherwise(F.col("species")))


def append(df: DataFrame, path: str) -> None:
    conform(df.filter("wkb is not null").withColumnRenamed("area", "geom_area") if "area" in df.columns else df.filter("wkb is not null")).select(SCHEMA.fieldNames()).write.mode("append").partitionBy("site", "species").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def init_layers(spark: SparkSession, path: str, site: str, force: bool = False) -> None:
    """Start a site without polygons; refused where it has some, unless forced."""
    try:
        n = load(spark, path).filter(F.col("site") == site).count()
    except Exception as e:  # no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        n = 0
    if n and not force:
        raise ValueError(f"site {site} has {n} polygons")
    if n:
        delete(spark, path, F.col("site") == site)


def delete(spark: SparkSession, path: str, where, keep_copy: str | None = None) -> int:
    """Remove the rows of a predicate. Partitions that hold some are rewritten one file set for another, and those that lose all
    their rows go last; the files of other sites and species are not touched, and what stays is on disk before anything is replaced."""
    from fieldloom.sources.tables import Scratch, remove

    rows, part = load(spark, path), ["site", "species"]
    hit = F.coalesce(where, F.lit(False))
    counts = rows.withColumn("file", F.input_file_name()).groupBy(*part).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"), F.min("file").alias("file")).filter("hits > 0")
    touched = counts.collect()  # one row per site and species that loses rows
    if not touched:
        return 0
    if keep_copy:
        rows.write.mode("errorifexists").partitionBy(*part).parquet(keep_copy)
    some = [r for r in touched if r["hits"] < r["n"]]
    if some:
        names = spark.createDataFrame([(r["site"], r["species"]) for r in some], "t_site string, t_species string")
        near = F.col("site").eqNullSafe(F.col("t_site")) & F.col("species").eqNullSafe(F.col("t_species"))
        rest = Scratch(spark).save(rows.filter(~hit).join(F.broadcast(names), near, "left_semi"))  # one row per partition
        rest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*part).parquet(path)
    for r in touched:
        if r["hits"] == r["n"]:
            remove(spark, r["file"].rsplit("/", 1)[0])
    return sum(r["hits"] for r in touched)
