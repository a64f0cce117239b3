"""Queries of the polygon kernel, of propagation and of the exchange, on boxes of ``part`` written as polygons."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.config import Settings
from fieldloom.functions import names, vec
from fieldloom.operators import exchange, lookup, metrics, models, pixels, polygons, propagate, spatial, vectors
from fieldloom.plans.catalogue import _EL, _PAIR, _PROTO, BOX_SQL, CELL, PIX_SQL, _protos, _table, boxes, pixel_rows, query
from fieldloom.sources.tables import Scratch


def shaped(spark, d):
    """The boxes with their polygons and areas."""
    return boxes(spark, d).withColumn("wkb", polygons.st_box()).withColumn("area", spatial.area())


# --- the polygon kernel ------------------------------------------------------------------------------------


@query("polygon_iou_join", f"WITH {BOX_SQL}, {_PAIR} SELECT a, b, round(iou, 6) AS iou FROM iou WHERE a < b AND iou > 0.05")
def _(spark, d):
    b = shaped(spark, d).select("id", "wkb", "area", *spatial.BOX)
    pairs = polygons.overlap_pairs(b, b, CELL, 0.05, more=F.col("l_id") < F.col("r_id"))
    return pairs.select(F.col("l_id").alias("a"), F.col("r_id").alias("b"), F.round("iou", 6).alias("iou"))


@query("polygon_anti_join", f"WITH {BOX_SQL}, {_PAIR} SELECT id FROM box WHERE (id // 500) % 2 = 0 AND NOT EXISTS (SELECT 1 FROM iou WHERE a = box.id AND (b // 500) % 2 = 1 AND iou > 0.3)")
def _(spark, d):
    b = shaped(spark, d)
    return polygons.without_duplicates(b.filter("id div 500 % 2 = 0"), b.filter("id div 500 % 2 = 1"), "id", CELL, 0.3).select("id")


@query("polygon_inside_fraction", f"WITH {BOX_SQL} SELECT id, round(greatest(least(x1, 700) - greatest(x0, 200), 0) * greatest(least(y1, 800) - greatest(y0, 100), 0) / ((x1-x0)*(y1-y0)), 6) AS frac FROM box")
def _(spark, d):
    return shaped(spark, d).select("id", F.round(polygons.st_inside((200.0, 100.0, 700.0, 800.0))("wkb"), 6).alias("frac"))


@query("polygon_make_valid", f"WITH {BOX_SQL} SELECT id, CAST(2 AS INT) AS parts, round((x1-x0)*(y1-y0) / 2, 6) AS area, x0, y0, x1, y1 FROM box")
def _(spark, d):
    bow = polygons.st_ring(F.array("x0", "y0", "x1", "y1", "x1", "y0", "x0", "y1"))
    b = boxes(spark, d).select("id", bow.alias("bow"))
    v = polygons.per_geometry(b, "bow", wkb=polygons.st_make_valid("bow"), parts=polygons.st_parts("wkb"), area=F.round(polygons.st_area("wkb"), 6), bounds=polygons.st_bounds("wkb"))
    return v.select("id", "parts", "area", *[F.col("bounds")[i].alias(c) for i, c in enumerate(spatial.BOX)])


@query("polygon_simplify", f"WITH {BOX_SQL} SELECT id, round((x1-x0)*(y1-y0), 6) AS area, round((x1-x0)*(y1-y0) + 0.01 * (x1-x0) / 2, 6) AS before FROM box")
def _(spark, d):
    x0, y0, x1, y1 = map(F.col, spatial.BOX)
    b = boxes(spark, d).select("id", polygons.st_ring(F.array(x0, y0, x1, y0, x1, y1, (x0 + x1) / 2, y1 + 0.01, x0, y1)).alias("wkb"))
    return b.select("id", F.round(polygons.st_area(polygons.st_simplify(0.02)("wkb")), 6).alias("area"), F.round(polygons.st_area("wkb"), 6).alias("before"))


def tile_boxes(spark):
    """Four rows of four tiles of 250 units and ten patches a side."""
    r, c = F.floor(F.col("id") / 4) * 250.0, (F.col("id") % 4) * 250.0
    t = spark.range(16).select(F.col("id").alias("tile_idx"), F.array(F.lit(1.0), F.lit(0.0), c, F.lit(0.0), F.lit(1.0), r).alias("transform"), F.lit(250).alias("size"), c.alias("x0"), r.alias("y0"))
    return t.withColumn("x1", F.col("x0") + 250).withColumn("y1", F.col("y0") + 250)


# half a unit aside, so that no edge lies on a line between cells
_CELLS = f"{BOX_SQL}, cx AS (SELECT id, unnest(range(CAST(floor((x0 + 0.5) / 25) AS BIGINT), CAST(floor((x1 + 0.5) / 25) AS BIGINT) + 1)) AS c, y0, y1 FROM box), cc AS (SELECT id, c, unnest(range(CAST(floor((y0 + 0.5) / 25) AS BIGINT), CAST(floor((y1 + 0.5) / 25) AS BIGINT) + 1)) AS r FROM cx), cell AS (SELECT id, (r // 10) * 4 + c // 10 AS tile_idx, CAST(r % 10 AS INT) AS pr, CAST(c % 10 AS INT) AS pc FROM cc WHERE r < 40 AND c < 40)"


def _cells(spark, d):
    moved = boxes(spark, d).select("id", "species", *[(F.col(c) + 0.5).alias(c) for c in spatial.BOX])
    return polygons.cover_cells(moved.withColumn("wkb", polygons.st_box()), tile_boxes(spark), "id", 10, 250.0)


@query("polygon_cover_cells", f"WITH {_CELLS} SELECT id, tile_idx, pr, pc FROM cell")
def _(spark, d):
    return _cells(spark, d)


@query("distinct_patches", f"WITH {_CELLS} SELECT species, count(*) AS n FROM (SELECT DISTINCT species, tile_idx, pr, pc FROM cell JOIN box ON cell.id = box.id) t GROUP BY species")
def _(spark, d):
    species = boxes(spark, d).select(F.col("id").alias("s_id"), "species")
    under = _cells(spark, d).join(species, F.col("id") == F.col("s_id")).dropDuplicates(["species", "tile_idx", "pr", "pc"])
    return under.groupBy("species").agg(F.count("*").alias("n"))


@query("polygon_burn", f"WITH {BOX_SQL}, c AS (SELECT id, source, unnest(range(CAST(x0 AS BIGINT), CAST(least(x1, 1000) AS BIGINT))) AS x, y0, y1 FROM box), g AS (SELECT *, unnest(range(CAST(y0 AS BIGINT), CAST(least(y1, 1000) AS BIGINT))) AS y FROM c), w AS (SELECT x, y, arg_max(id % 7, (CASE WHEN nullif(source, '') IS NULL THEN 2 ELSE 1 END) * 1000 - id % 7) AS cls FROM g GROUP BY x, y) SELECT CAST(cls AS INT) AS cls, count(*) AS n FROM w GROUP BY cls")
def _(spark, d):
    b = shaped(spark, d).withColumn("value", F.col("id") % 7).withColumn("band", F.when(lookup.is_seed(F.col("source"), lookup.MANUAL), 2.0).otherwise(1.0))
    blocks = polygons.burn(b, 1000, 1000, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0), "value", "band", "value")
    return models.byte_counts(blocks).filter(F.col("cls") != metrics.NODATA)


@query("polygonize_regions", f"WITH {PIX_SQL} SELECT CAST((x // 10 + y // 10) % 5 AS BIGINT) AS label, count(*) AS cells, CAST(count(*) AS DOUBLE) AS area, CAST(min(x) AS DOUBLE) AS x0, CAST(min(y) AS DOUBLE) AS y0, CAST(max(x) + 1 AS DOUBLE) AS x1, CAST(max(y) + 1 AS DOUBLE) AS y1 FROM pix GROUP BY x // 10, y // 10 HAVING count(*) >= 20")
def _(spark, d):
    p = pixel_rows(spark, d)
    cells = p.select("x", "y", ((F.floor(F.col("x") / 10) + F.floor(F.col("y") / 10)) % 5).alias("label"))
    return polygons.polygonize(cells, "label", Scratch(spark), 20).select("label", "cells", "area", *spatial.BOX)


@query("burn_boxes_counts", f"WITH {BOX_SQL}, c AS (SELECT id, unnest(range(CAST(x0 AS BIGINT), CAST(x1 AS BIGINT))) AS x, y0, y1 FROM box), g AS (SELECT *, unnest(range(CAST(y0 AS BIGINT), CAST(y1 AS BIGINT))) AS y FROM c), w AS (SELECT x, y, min(id) AS id FROM g GROUP BY x, y) SELECT id, count(*) AS n FROM w GROUP BY id")
def _(spark, d):
    b = boxes(spark, d)
    width, height = (int(n or 0) for n in b.agg(F.max("x1"), F.max("y1")).first())
    return pixels.burn_boxes(b, width, height, F.col("id"), F.lit(1.0), F.col("id")).groupBy(F.col("value").alias("id")).agg(F.count("*").alias("n"))


# --- prototypes and propagation ----------------------------------------------------------------------------


@query("prototype_mean", f"WITH {_PROTO} SELECT CAST(i - 1 AS INT) AS i, round(v, 5) + 0 AS v FROM p WHERE label = 3")
def _(spark, d):
    p = vectors.build_prototype(_table(spark, d, "embeddings").filter("label = 3"), "vec_id", "embedding", 1)
    return p.select(F.posexplode("proto").alias("i", "v")).select("i", F.round("v", 5).alias("v"))


@query("prototype_few", f"WITH {_EL}, f AS (SELECT * FROM e WHERE vec_id < 5), n AS (SELECT vec_id, sqrt(sum(CAST(v AS DOUBLE) * v)) AS n FROM f GROUP BY vec_id) SELECT CAST(f.vec_id AS INT) AS k, CAST(f.i - 1 AS INT) AS i, round(CAST(f.v AS DOUBLE) / greatest(n.n, 1e-8), 5) + 0 AS v FROM f JOIN n ON f.vec_id = n.vec_id")
def _(spark, d):
    p = vectors.build_prototype(_table(spark, d, "embeddings").filter("vec_id < 5"), "vec_id", "embedding", 5)
    return p.select("k", F.posexplode("proto").alias("i", "v")).select("k", "i", F.round("v", 5).alias("v"))


_RULES = Settings(threshold=0.1, margin=0.02, min_area=4.0, max_area=2000.0, dup_iou=0.05)


@query("propagate_species", f"WITH {BOX_SQL}, {_PAIR}, {_PROTO}, u AS (SELECT vec_id, sqrt(sum(CAST(v AS DOUBLE) * v)) AS n FROM e GROUP BY vec_id), o AS (SELECT s.vec_id, max(CASE WHEN proto = 3 THEN sim / greatest(u.n, 1e-8) END) AS sim_x, coalesce(max(CASE WHEN proto <> 3 THEN sim / greatest(u.n, 1e-8) END), 0) AS sim_rest FROM s JOIN u ON s.vec_id = u.vec_id GROUP BY s.vec_id) SELECT id, round(sim_x, 4) AS score, (x1-x0)*(y1-y0) AS area, 'auto' AS source FROM box JOIN o ON id = vec_id WHERE (id // 100) % 2 = 0 AND sim_x >= 0.1 AND sim_x - sim_rest >= 0.02 AND (x1-x0)*(y1-y0) BETWEEN 4 AND 2000 AND NOT EXISTS (SELECT 1 FROM iou WHERE a = box.id AND (b // 100) % 2 = 1 AND iou > 0.05)")
def _(spark, d):
    e, p = _protos(spark, d)
    b = shaped(spark, d)
    feats = e.select(F.col("vec_id").alias("f_id"), vec.l2norm(F.col("embedding")).alias("feat"))
    candidates = b.filter("id div 100 % 2 = 0").join(feats, F.col("id") == F.col("f_id")).select("id", "feat", "wkb", "area", *spatial.BOX)
    protos = p.select(F.col("proto").alias("species"), F.col("pv").alias("proto"))
    new, _ = propagate.propagate(candidates, "id", b.filter("id div 100 % 2 = 1"), protos, 3, "now", CELL, _RULES)
    return new.select("id", "score", F.round("area", 6).alias("area"), "source")


# --- ordered greedy rules and the exchange -----------------------------------------------------------------


def _greedy_sql(rows: str, edges: str) -> str:
    """Accepts in order: one step of the recursion per row. ``rows`` yields (id), ``edges`` (late, early)."""
    return f"rw AS MATERIALIZED (SELECT r.id, row_number() OVER (ORDER BY r.id) AS n, coalesce(x.early, []) AS early FROM ({rows}) r LEFT JOIN (SELECT late, list(early) AS early FROM ({edges}) GROUP BY late) x ON r.id = x.late), g AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS kept UNION ALL SELECT rw.n, CASE WHEN list_has_any(g.kept, rw.early) THEN g.kept ELSE list_append(g.kept, rw.id) END FROM g JOIN rw ON rw.n = g.n + 1), greedy AS (SELECT unnest(kept) AS id FROM (SELECT arg_max(kept, n) AS kept FROM g))"


@query("greedy_dedup", f"WITH RECURSIVE {BOX_SQL}, {_PAIR}, {_greedy_sql('SELECT id FROM box', 'SELECT a AS late, b AS early FROM iou WHERE b < a AND iou >= 0.3')} SELECT id FROM greedy")
def _(spark, d):
    b = boxes(spark, d).select("id", *spatial.BOX)
    return spatial.greedy_dedup(b, "id", "id", CELL, 0.3, Scratch(spark)).select("id")


_OURS = "CASE CAST(id AS BIGINT) % 5 WHEN 0 THEN 'Empidisma_minus' WHEN 1 THEN 'Poa_costiniana' WHEN 2 THEN 'Sphagnum' WHEN 3 THEN 'Carex_gaudichaudiana' END"
_THEIRS = "CASE CAST(id AS BIGINT) % 5 WHEN 0 THEN 'E. minus' WHEN 1 THEN 'Poa_costiniana' WHEN 2 THEN 'Bog moss' WHEN 3 THEN 'C. gaudichaudiana' ELSE 'unknown thing' END"
_IMPORT = f"""{BOX_SQL}, {_PAIR}, m AS (SELECT id, {_OURS} AS ours, {_THEIRS} AS theirs, greatest(least(x1, 900) - greatest(x0, 100), 0) * greatest(least(y1, 900) - greatest(y0, 100), 0) / ((x1-x0)*(y1-y0)) AS f FROM box),
 ok AS (SELECT * FROM m WHERE id % 4 <> 0 AND ours IS NOT NULL AND f >= 0.5),
 fresh AS (SELECT * FROM ok WHERE id % 9 <> 1 AND NOT EXISTS (SELECT 1 FROM iou JOIN m q ON q.id = b WHERE a = ok.id AND b % 4 = 0 AND q.ours = ok.ours AND iou >= 0.2))"""
_SAME = "SELECT a AS late, b AS early FROM iou JOIN fresh l ON l.id = a JOIN fresh r ON r.id = b WHERE b < a AND iou >= 0.2 AND l.ours = r.ours"


def _imported(spark, d):
    """A quarter of the boxes is there already; every ninth of the rest was imported before."""
    dealt = boxes(spark, d).repartition(2 * spark.sparkContext.defaultParallelism, "id")  # a small file is one task or two, and its polygons take time
    b = dealt.withColumn("wkb", polygons.st_box()).withColumn("area", spatial.area())
    theirs, ours = F.expr(_THEIRS), F.expr(_OURS)
    rows = b.filter("id % 4 <> 0").select(F.lit("l").alias("layer"), F.col("id").alias("fid"), F.lit(0).alias("part"), "wkb", "area", *spatial.BOX, F.create_map(F.lit("name"), theirs).alias("attrs"))
    known = [(i, c) for i, c in enumerate(("Empidisma_minus", "Poa_costiniana", "Carex_gaudichaudiana", "Sphagnum"))]
    classes = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(i).alias("class_id"), F.lit(c).alias("name")) for i, c in known])))
    old = b.filter("id % 4 = 0").select(ours.alias("species"), F.lit(None).cast("string").alias("lb_note"), "wkb", "area", *spatial.BOX)
    # what was imported before is known by its key alone: its polygon lies elsewhere now
    far = b.filter("id % 4 <> 0 and id % 9 = 1").select(ours.alias("species"), names.provenance(F.lit("f"), F.lit("l"), F.col("id"), F.lit(0)).alias("lb_note"), "wkb", "area", *[(F.col(c) + 5000).alias(c) for c in spatial.BOX])
    over = names.overrides(["bog moss=Sphagnum"], {c for _, c in known})
    return exchange.import_rows(rows, old.unionByName(far), classes, "name", "f", (100.0, 100.0, 900.0, 900.0), over, 0.5, 0.2, CELL, Scratch(spark))


@query("import_polygons", f"WITH RECURSIVE {_IMPORT}, {_greedy_sql('SELECT id FROM fresh', _SAME)} SELECT greedy.id AS fid, ours AS species, 'nesp:f|l|' || CAST(greedy.id AS VARCHAR) AS lb_note FROM greedy JOIN m ON m.id = greedy.id")
def _(spark, d):
    return _imported(spark, d)[0].select("fid", "species", "lb_note")


@query("import_report", f"WITH RECURSIVE {_IMPORT}, {_greedy_sql('SELECT id FROM fresh', _SAME)} SELECT theirs, count(*) AS read, CAST(count_if(ours IS NOT NULL AND f >= 0.5) AS BIGINT) AS inside, count(greedy.id) AS new, CAST(count_if(ours IS NOT NULL AND f >= 0.5) - count(greedy.id) AS BIGINT) AS dup FROM m LEFT JOIN greedy ON greedy.id = m.id WHERE m.id % 4 <> 0 GROUP BY theirs")
def _(spark, d):
    return _imported(spark, d)[1].select("theirs", "read", "inside", "new", "dup")


_EXPORT = f"{BOX_SQL}, {_PAIR}, w AS (SELECT id, species AS layer, CASE WHEN source = 'nesp' THEN 'nesp' WHEN id % 3 = 0 THEN 'logged' WHEN id % 7 = 0 OR EXISTS (SELECT 1 FROM iou WHERE a = box.id AND b % 7 = 0 AND iou >= 0.6) THEN 'overlap' ELSE 'send' END AS why FROM box)"


def _exported(spark, d):
    b = shaped(spark, d)
    rows = b.select(F.col("species").alias("layer"), F.concat_ws("_", "species", F.lit("alpina")).alias("species"), F.col("id").alias("fid"), F.lit(0).alias("part"), "source", "wkb", "area", *spatial.BOX)
    log = b.filter("id % 3 = 0").select(F.col("species").alias("layer"), F.col("id").alias("fid"))
    return exchange.export_rows(rows, b.filter("id % 7 = 0"), log, CELL, Scratch(spark), 0.6, learned={"SMALL_alpina": "small one"}, overrides={"LARGE_alpina": "Big alpine"})


@query("export_polygons", f"WITH {_EXPORT} SELECT CAST((SELECT max(id) FROM box WHERE id % 7 = 0) + row_number() OVER (ORDER BY layer, id) AS BIGINT) AS new_id, CASE layer WHEN 'SMALL' THEN 'small one' WHEN 'LARGE' THEN 'Big alpine' ELSE left(layer, 1) || '. alpina' END AS their_name, layer, id AS fid FROM w WHERE why = 'send'")
def _(spark, d):
    return _exported(spark, d)[0].select("new_id", "their_name", "layer", "fid")


@query("export_counts", f"WITH {_EXPORT} SELECT layer, count(*) AS have, CAST(count_if(why = 'nesp') AS BIGINT) AS nesp, CAST(count_if(why = 'logged') AS BIGINT) AS logged, CAST(count_if(why = 'overlap') AS BIGINT) AS overlap, CAST(count_if(why = 'send') AS BIGINT) AS send FROM w GROUP BY layer")
def _(spark, d):
    return _exported(spark, d)[1]


_SPELT = "SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'E. minus' WHEN 1 THEN 'Empidisma minus' ELSE 'Poa costiniana' END AS theirs, p_size FROM part"


@query("learned_spelling", f"SELECT CASE WHEN id % 3 = 2 THEN 'Poa_costiniana' ELSE 'Empidisma_minus' END AS species, arg_min(theirs, p_size * 1000000 + id) AS spelling FROM ({_SPELT}) t GROUP BY 1")
def _(spark, d):
    k = F.col("p_partkey") % 3
    name = F.when(k == 0, "E. minus").when(k == 1, "Empidisma minus").otherwise("Poa costiniana")
    classes = spark.createDataFrame([(1, "Empidisma_minus"), (2, "Poa_costiniana")], "class_id int, name string")
    return lookup.learned_spelling(_table(spark, d, "part").withColumn("theirs", name), "theirs", ["p_size", "p_partkey"], classes, {})


@query("named_classes", "SELECT p_partkey AS cluster_id, CAST(CASE p_partkey % 4 WHEN 1 THEN 3 WHEN 2 THEN 6 ELSE 0 END AS INT) AS class_id FROM part")
def _(spark, d):
    k = F.col("p_partkey") % 4
    rows = _table(spark, d, "part").select(F.col("p_partkey").alias("cluster_id"), F.when(k == 1, " Poa_costiniana").when(k == 2, "Sphagnum").when(k == 3, " ").alias("species"))
    return lookup.named_classes(rows, spark.createDataFrame(sorted(Settings().classes.items()), "class_id int, name string"))


@query("tile_index", "SELECT stem, CAST(row_number() OVER (ORDER BY stem) - 1 AS BIGINT) AS tile_idx FROM (SELECT DISTINCT p_type || p_brand || p_name AS stem FROM part) t")
def _(spark, d):
    stems = _table(spark, d, "part").select(F.concat("p_type", "p_brand", "p_name").alias("stem")).distinct()
    return lookup.numbered(stems, ["stem"], Scratch(spark), "n").select("stem", (F.col("n") - 1).cast("long").alias("tile_idx"))


@query("layer_colour", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '#911eb4' WHEN 1 THEN '#e6194b' WHEN 2 THEN '#f58231' ELSE '#ff00ff' END AS colour FROM customer")
def _(spark, d):
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, "Sphagnum").when(k == 1, "new one").when(k == 2, "another").otherwise("nowhere")
    return _table(spark, d, "customer").select("c_custkey", names.colour(name, ["new one", "another"]).alias("colour"))
