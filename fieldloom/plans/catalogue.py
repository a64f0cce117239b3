"""The engine's operators applied to the star-schema tables, each beside its SQL.

Boxes come from ``part``, pixels from ``events``, vectors from ``embeddings``; see the views below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldloom.functions import geo, grid, names, vec
from fieldloom.operators import lookup, metrics, pixels, spatial, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

W, TILE, OVERLAP, CELL = 100, 32, 8, 25.0

BOX_SQL = "box AS (SELECT p_partkey AS id, CAST((p_partkey * 37) % 1000 AS DOUBLE) AS x0, CAST((p_partkey * 91) % 1000 AS DOUBLE) AS y0, CAST((p_partkey * 37) % 1000 + p_size AS DOUBLE) AS x1, CAST((p_partkey * 91) % 1000 + p_size AS DOUBLE) AS y1, p_type AS species, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'auto' ELSE 'nesp' END AS source FROM part)"
IOU_SQL = "greatest(least(a.x1,b.x1)-greatest(a.x0,b.x0),0)*greatest(least(a.y1,b.y1)-greatest(a.y0,b.y0),0)"
PIX_SQL = "pix AS (SELECT event_id AS pid, CAST(event_id % 100 AS BIGINT) AS x, CAST(event_id // 100 AS BIGINT) AS y, event_type AS cls, CAST(floor(value) AS BIGINT) % 20 AS cluster, value FROM events)"
DOT_SQL = "sum(CAST(a AS DOUBLE) * CAST(b AS DOUBLE))"


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def boxes(spark: SparkSession, d: str) -> DataFrame:
    p = _table(spark, d, "part")
    x, y = (F.col("p_partkey") * 37) % 1000, (F.col("p_partkey") * 91) % 1000
    k = F.col("p_partkey") % 4
    source = F.when(k == 0, F.lit(None)).when(k == 1, "").when(k == 2, "auto").otherwise("nesp")
    corners = [c.cast("double").alias(n) for c, n in ((x, "x0"), (y, "y0"), (x + F.col("p_size"), "x1"), (y + F.col("p_size"), "y1"))]
    return p.select(F.col("p_partkey").alias("id"), *corners, F.col("p_type").alias("species"), source.alias("source"))


def pixel_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row per cell of a raster 100 wide and as high as there are events: their ids number the cells."""
    return _table(spark, d, "events").select(
        F.col("event_id").alias("pid"), (F.col("event_id") % 100).alias("x"), F.floor(F.col("event_id") / 100).alias("y"),
        F.col("event_type").alias("cls"), (F.floor("value") % 20).alias("cluster"), "value",
    )


def raster_height(spark: SparkSession, d: str) -> int:
    return (_table(spark, d, "events").agg(F.max("event_id")).first()[0] or 0) // W + 1


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


# --- vectors -----------------------------------------------------------------------------------------------

_EL = "e AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)"
_PROTO = f"{_EL}, m AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m FROM e GROUP BY label, i), n AS (SELECT label, sqrt(sum(m * m)) AS n FROM m GROUP BY label), p AS (SELECT m.label, m.i, m.m / greatest(n.n, 1e-8) AS v FROM m JOIN n ON m.label = n.label), s AS (SELECT e.vec_id, p.label AS proto, sum(CAST(e.v AS DOUBLE) * p.v) AS sim FROM e JOIN p ON e.i = p.i GROUP BY e.vec_id, p.label)"


def _protos(spark, d):
    e = _table(spark, d, "embeddings")
    return e, vectors.mean_vector(e, "label", "embedding").select(F.col("label").alias("proto"), vec.l2norm(F.col("mean")).alias("pv"))


@query("vec_l2norm", f"WITH {_EL}, n AS (SELECT vec_id, sqrt(sum(CAST(v AS DOUBLE) * v)) AS n FROM e GROUP BY vec_id) SELECT e.vec_id, CAST(e.i - 1 AS INT) AS i, round(CAST(e.v AS DOUBLE) / greatest(n.n, 1e-8), 5) + 0 AS unit FROM e JOIN n ON e.vec_id = n.vec_id")
def _(spark, d):
    e = _table(spark, d, "embeddings")
    return e.select("vec_id", F.posexplode(vec.l2norm(F.col("embedding"))).alias("i", "u")).select("vec_id", "i", F.round("u", 5).alias("unit"))


@query("vec_mean_by_label", f"WITH {_EL} SELECT label, CAST(i - 1 AS INT) AS i, round(avg(CAST(v AS DOUBLE)), 5) + 0 AS mean FROM e GROUP BY label, i")
def _(spark, d):
    m = vectors.mean_vector(_table(spark, d, "embeddings"), "label", "embedding")
    return m.select("label", F.posexplode("mean").alias("i", "m")).select("label", "i", F.round("m", 5).alias("mean"))


@query("proto_max_cosine", f"WITH {_PROTO} SELECT vec_id, best, sim FROM (SELECT vec_id, proto AS best, round(sim, 6) AS sim, row_number() OVER (PARTITION BY vec_id ORDER BY round(sim, 6) DESC, proto) AS r FROM s) WHERE r = 1")
def _(spark, d):
    e, p = _protos(spark, d)
    return vectors.best_prototype(e, p, "vec_id", "embedding", "proto", "pv")


@query("one_vs_rest", f"WITH {_PROTO}, o AS (SELECT vec_id, max(CASE WHEN proto = 3 THEN sim END) AS sim_x, coalesce(max(CASE WHEN proto <> 3 THEN sim END), 0) AS sim_rest FROM s GROUP BY vec_id) SELECT vec_id, round(sim_x, 5) AS sim_x, round(sim_rest, 5) AS sim_rest FROM o WHERE sim_x >= 0.2 AND sim_x - sim_rest >= 0.05")
def _(spark, d):
    e, p = _protos(spark, d)
    out = vectors.one_vs_rest(e, p, "vec_id", "embedding", "proto", "pv", 3, 0.2, 0.05)
    return out.select("vec_id", F.round("sim_x", 5).alias("sim_x"), F.round("sim_rest", 5).alias("sim_rest"))


@query("sim_histogram", f"WITH {_PROTO} SELECT CAST(least(floor(sim * 10), 9) AS BIGINT) AS bin, count(*) AS n FROM s WHERE proto = 3 AND sim BETWEEN 0 AND 1 GROUP BY 1")
def _(spark, d):
    e, p = _protos(spark, d)
    one = p.filter("proto = 3").select("pv")
    return vectors.histogram(e.crossJoin(F.broadcast(one)).select(vec.dot(F.col("embedding"), F.col("pv")).alias("sim")), "sim")


@query("kmeans_assign_fixed", f"WITH {_EL}, x AS (SELECT a.vec_id, b.vec_id AS cluster_id, round(sum((CAST(a.v AS DOUBLE) - b.v) * (CAST(a.v AS DOUBLE) - b.v)), 6) AS dist FROM e a JOIN e b ON a.i = b.i AND b.vec_id < 8 GROUP BY 1, 2) SELECT vec_id, cluster_id, dist FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster_id) AS r FROM x) WHERE r = 1")
def _(spark, d):
    e = _table(spark, d, "embeddings")
    c = e.filter("vec_id < 8").select(F.col("vec_id").alias("cluster_id"), F.col("embedding").alias("centre"))
    return vectors.assign_centroids(e, c, "vec_id", "embedding", "cluster_id", "centre")


@query("vec_topk", f"WITH {_PROTO} SELECT vec_id, round(sim, 5) AS sim, rank FROM (SELECT vec_id, sim, row_number() OVER (ORDER BY round(sim, 6) DESC, vec_id) AS rank FROM s WHERE proto = 3) WHERE rank <= 20")
def _(spark, d):
    e, p = _protos(spark, d)
    one = p.filter("proto = 3").select("pv")
    top = e.crossJoin(F.broadcast(one)).select("vec_id", vec.dot(F.col("embedding"), F.col("pv")).alias("sim")).orderBy(F.desc(F.round("sim", 6)), "vec_id").limit(20)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(F.round("sim", 6)), "vec_id")).cast("long")).select("vec_id", F.round("sim", 5).alias("sim"), "rank")


@query("featurize_nonzero", f"WITH {_EL}, k AS (SELECT p_partkey AS k FROM part), m AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m FROM e GROUP BY label, i), n AS (SELECT label, sqrt(sum(m * m)) AS n FROM m GROUP BY label) SELECT k.k AS poly, round(sqrt(sum((m.m / n.n) * (m.m / n.n))), 5) AS norm FROM k JOIN m ON k.k = m.label JOIN n ON m.label = n.label WHERE n.n > 1e-6 GROUP BY k.k")
def _(spark, d):
    keys = _table(spark, d, "part").select(F.col("p_partkey").alias("poly"))
    f = vectors.featurize(keys, _table(spark, d, "embeddings").withColumnRenamed("label", "poly"), "poly", "embedding")
    return f.select("poly", vec.norm(F.col("feat")).alias("n")).filter("n > 1e-6").select("poly", F.round("n", 5).alias("norm"))


# --- tiles and pixels --------------------------------------------------------------------------------------


@query("tile_grid", "SELECT CAST(r AS BIGINT) AS row_idx, CAST(c AS BIGINT) AS col_idx, CAST(r * 24 AS BIGINT) AS row_off, CAST(c * 24 AS BIGINT) AS col_off, CAST(least(32, 100 - r * 24) AS BIGINT) AS actual_h, CAST(least(32, 100 - c * 24) AS BIGINT) AS actual_w, 'tile_r' || lpad(CAST(r AS VARCHAR), 4, '0') || '_c' || lpad(CAST(c AS VARCHAR), 4, '0') AS stem FROM (SELECT unnest(range(0, 4)) AS r) a, (SELECT unnest(range(0, 4)) AS c) b")
def _(spark, d):
    return grid.tile_grid(spark, W, W, TILE, OVERLAP)


_COVER = f"{PIX_SQL}, t AS (SELECT unnest(range(0, 4)) AS k), u AS (SELECT unnest(range(0, CAST(ceil(((SELECT max(event_id) // 100 + 1 FROM events) - 8) / 24.0) AS BIGINT))) AS k), cov AS (SELECT p.*, CAST(r.k AS INT) AS row_idx, CAST(c.k AS INT) AS col_idx FROM pix p JOIN u r ON p.y >= r.k * 24 AND p.y < r.k * 24 + 32 JOIN t c ON p.x >= c.k * 24 AND p.x < c.k * 24 + 32)"


def _covered(spark, d):
    return pixels.covered(pixel_rows(spark, d), W, raster_height(spark, d), TILE, OVERLAP)


@query("tile_cover_count", f"WITH {_COVER}, n AS (SELECT pid, count(*) AS tiles FROM cov GROUP BY pid) SELECT tiles, count(*) AS pixels FROM n GROUP BY tiles")
def _(spark, d):
    return _covered(spark, d).groupBy("pid").agg(F.count("*").alias("tiles")).groupBy("tiles").agg(F.count("*").alias("pixels"))


@query("tile_valid_fraction", f"WITH {_COVER} SELECT row_idx, col_idx, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 6) AS valid_frac FROM cov GROUP BY 1, 2 HAVING avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END) >= 0.1")
def _(spark, d):
    v = _covered(spark, d).groupBy("row_idx", "col_idx").agg(F.avg(F.when(F.col("value") > 50, 1.0).otherwise(0.0)).alias("valid_frac"))
    return v.filter("valid_frac >= 0.1").withColumn("valid_frac", F.round("valid_frac", 6))


_SCORE = "(pid * 7919 + row_idx * 31 + col_idx * 17 + k * 104729) % 1000 / 1000.0"


@query("overlap_mean_argmax", f"WITH {_COVER}, l AS (SELECT x, y, k, round(avg({_SCORE}), 9) AS m FROM cov, (SELECT unnest(range(0, 4)) AS k) c GROUP BY 1, 2, 3) SELECT x, y, CAST(k AS BIGINT) AS k FROM (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY m DESC, k) AS r FROM l) WHERE r = 1")
def _(spark, d):
    c = _covered(spark, d).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    return pixels.vote(c.withColumn("score", F.expr(_SCORE.replace("1000.0", "1000.0D"))), "k", "score")


@query("mosaic_last_wins", f"WITH {_COVER} SELECT x, y, CAST(pid * 10 + row_idx * 4 + col_idx AS BIGINT) AS v FROM (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY row_idx DESC, col_idx DESC) AS r FROM cov) WHERE r = 1")
def _(spark, d):
    return pixels.last_wins(_covered(spark, d).withColumn("v", F.col("pid") * 10 + F.col("row_idx") * 4 + F.col("col_idx")), "v")


@query("nearest_upsample", f"WITH {PIX_SQL} SELECT x, y, CAST(least((x * 36) // 100, 35) AS BIGINT) AS pc, CAST(least((y * 36) // 100, 35) AS BIGINT) AS pr FROM pix")
def _(spark, d):
    return pixel_rows(spark, d).select("x", "y", grid.nearest_index(F.col("x"), W, 36).alias("pc"), grid.nearest_index(F.col("y"), W, 36).alias("pr"))


@query("patch_centre_xy", "SELECT CAST(k AS BIGINT) AS pc, round(500000 + ((k + 0.5) * 512 / 36 + 0.5) * 0.05, 6) AS x, round(4000000 - ((k + 0.5) * 512 / 36 + 0.5) * 0.05, 6) AS y FROM (SELECT unnest(range(0, 36)) AS k) t")
def _(spark, d):
    t = spark.range(36).select(F.col("id").alias("pc"), grid.patch_centre(F.col("id"), 512, 36).alias("p"))
    x, y = grid.world((0.05, 0.0, 500000.0, 0.0, -0.05, 4000000.0), F.col("p"), F.col("p"))
    return t.select("pc", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query("patch_grid_size", f"WITH {PIX_SQL} SELECT DISTINCT CAST(greatest((pid // 14) * 14, 14) AS BIGINT) AS px, CAST(greatest((pid // 14) * 14, 14) // 14 AS BIGINT) AS patches FROM pix")
def _(spark, d):
    px = grid.patch_extent(F.col("pid")).cast("long")
    return pixel_rows(spark, d).select(px.alias("px"), F.floor(px / 14).alias("patches")).distinct()


@query("cluster_to_class", f"WITH {PIX_SQL} SELECT pid, CAST(CASE cluster WHEN 1 THEN 3 WHEN 2 THEN 1 WHEN 5 THEN 3 WHEN 7 THEN 2 ELSE 0 END AS INT) AS class_id FROM pix")
def _(spark, d):
    return pixel_rows(spark, d).select("pid", lookup.map_classes(None, {1: 3, 2: 1, 5: 3, 7: 2}, F.col("cluster").cast("int")).alias("class_id"))


# --- distributions and metrics -----------------------------------------------------------------------------

_CLS = f"{PIX_SQL}, c AS (SELECT CASE WHEN cluster >= 18 THEN 255 ELSE cluster % 8 END AS cls FROM pix)"


def _classes(spark, d):
    return pixel_rows(spark, d).select(F.when(F.col("cluster") >= 18, F.lit(255).cast("long")).otherwise(F.col("cluster") % 8).alias("cls"))


@query("class_distribution_incl", f"WITH {_CLS} SELECT * FROM (SELECT CAST(cls AS BIGINT) AS cls, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM c GROUP BY cls) WHERE cls <> 255")
def _(spark, d):
    return metrics.class_distribution(_classes(spark, d), "cls", True).withColumn("pct", F.round("pct", 6))


@query("class_distribution_excl", f"WITH {_CLS} SELECT CAST(cls AS BIGINT) AS cls, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM c WHERE cls <> 255 GROUP BY cls")
def _(spark, d):
    return metrics.class_distribution(_classes(spark, d), "cls", False).withColumn("pct", F.round("pct", 6))


def _iou_sql(src: str, t: str, p: str) -> str:
    return f"k AS (SELECT {t} AS cls FROM {src} UNION SELECT {p} FROM {src}), q AS (SELECT k.cls, count_if(s.{t} = k.cls AND s.{p} = k.cls) AS inter, count_if(s.{t} = k.cls OR s.{p} = k.cls) AS uni FROM k, {src} s GROUP BY k.cls)"


@query("iou_per_class", f"WITH {_iou_sql('labels', 'quality', 'toxic')} SELECT CAST(cls AS INT) AS cls, CAST(inter AS BIGINT) AS inter, CAST(uni AS BIGINT) AS uni, round(inter / nullif(CAST(uni AS DOUBLE), 0), 6) AS iou FROM q")
def _(spark, d):
    return metrics.iou_per_class(_table(spark, d, "labels"), "quality", "toxic").withColumn("iou", F.round("iou", 6))


_PRED = f"{PIX_SQL}, pr AS (SELECT cluster % 8 AS t, (cluster + pid) % 8 AS p FROM pix WHERE cluster % 8 <> 7)"


def _predicted(spark, d):
    return pixel_rows(spark, d).select((F.col("cluster") % 8).alias("t"), ((F.col("cluster") + F.col("pid")) % 8).alias("p"))


@query("iou_per_class_pixels", f"WITH {_PRED}, {_iou_sql('pr', 't', 'p')} SELECT CAST(cls AS BIGINT) AS cls, CAST(inter AS BIGINT) AS inter, CAST(uni AS BIGINT) AS uni, round(inter / nullif(CAST(uni AS DOUBLE), 0), 6) AS iou FROM q")
def _(spark, d):
    return metrics.iou_per_class(_predicted(spark, d), "t", "p", 7).withColumn("iou", F.round("iou", 6))


@query("mean_iou", f"WITH {_PRED}, {_iou_sql('pr', 't', 'p')} SELECT round(avg(inter / nullif(CAST(uni AS DOUBLE), 0)), 6) AS miou, round(sum(inter) / CAST(sum(uni) AS DOUBLE), 6) AS weighted_miou FROM q")
def _(spark, d):
    m = metrics.mean_iou(metrics.iou_per_class(_predicted(spark, d), "t", "p", 7))
    return m.select(F.round("miou", 6).alias("miou"), F.round("weighted_miou", 6).alias("weighted_miou"))


@query("focal_loss", f"WITH {PIX_SQL}, z AS (SELECT cluster % 3 AS t, (pid % 7) / 3.0 AS a, (pid % 11) / 5.0 AS b, (pid % 13) / 6.0 AS c FROM pix), q AS (SELECT ln(exp(a) + exp(b) + exp(c)) - CASE t WHEN 0 THEN a WHEN 1 THEN b ELSE c END AS ce FROM z) SELECT round(avg(power(1 - exp(-ce), 2) * ce), 6) AS loss FROM q")
def _(spark, d):
    p = pixel_rows(spark, d)
    logits = F.array(F.col("pid") % 7 / 3.0, F.col("pid") % 11 / 5.0, F.col("pid") % 13 / 6.0)
    return metrics.focal_loss(p, logits, F.col("cluster") % 3).select(F.round("loss", 6).alias("loss"))


@query("cosine_lr", "SELECT CAST(e AS BIGINT) AS epoch, round(0.000001 + 0.5 * (0.0001 - 0.000001) * (1 + cos(pi() * e / 50)), 9) AS lr FROM (SELECT unnest(range(0, 50)) AS e) t")
def _(spark, d):
    return spark.range(50).select(F.col("id").alias("epoch"), F.round(metrics.cosine_lr(F.col("id"), 50, 1e-4), 9).alias("lr"))


_DAYS = "d AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS m FROM events GROUP BY 1)"


@query("running_best", f"WITH {_DAYS}, b AS (SELECT day, m, max(m) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM d) SELECT CAST(day AS VARCHAR) AS day, round(m, 6) AS metric FROM b WHERE best IS NULL OR m > best")
def _(spark, d):
    days = _table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.avg("value").alias("metric"))
    return metrics.running_best(days, "day", "metric").select(F.col("day").cast("string").alias("day"), F.round("metric", 6).alias("metric"))


@query("mean_epoch_loss", f"WITH {_DAYS} SELECT round(avg(m), 6) AS loss, count(*) AS batches FROM d")
def _(spark, d):
    days = _table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.avg("value").alias("m"))
    return days.agg(F.round(F.avg("m"), 6).alias("loss"), F.count("*").alias("batches"))


# --- boxes -------------------------------------------------------------------------------------------------


@query("bbox_range_join", f"WITH {BOX_SQL}, t AS (SELECT CAST(r * 4 + c AS BIGINT) AS tile, c * 250.0 AS x0, r * 250.0 AS y0, c * 250.0 + 300 AS x1, r * 250.0 + 300 AS y1 FROM (SELECT unnest(range(0, 4)) AS r) a, (SELECT unnest(range(0, 4)) AS c) b) SELECT a.id, t.tile FROM box a JOIN t ON NOT (a.x1 < t.x0 OR a.x0 > t.x1 OR a.y1 < t.y0 OR a.y0 > t.y1)")
def _(spark, d):
    r, c = F.floor(F.col("id") / 4), F.col("id") % 4
    t = spark.range(16).select(F.col("id").alias("tile"), (c * 250.0).alias("x0"), (r * 250.0).alias("y0"), (c * 250.0 + 300).alias("x1"), (r * 250.0 + 300).alias("y1"))
    return spatial.box_join(spatial.prefixed(boxes(spark, d).select("id", *spatial.BOX), "l_"), spatial.prefixed(t, "r_"), CELL).select(F.col("l_id").alias("id"), F.col("r_tile").alias("tile"))


_PAIR = f"pair AS (SELECT a.id AS a, b.id AS b, {IOU_SQL} AS i, (a.x1-a.x0)*(a.y1-a.y0) AS sa, (b.x1-b.x0)*(b.y1-b.y0) AS sb, a.species AS sp_a, b.species AS sp_b FROM box a JOIN box b ON a.id <> b.id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1), iou AS (SELECT *, i / (sa + sb - i) AS iou FROM pair)"


@query("box_iou_join", f"WITH {BOX_SQL}, {_PAIR} SELECT a, b, round(iou, 6) AS iou FROM iou WHERE a < b AND iou > 0.05")
def _(spark, d):
    b = boxes(spark, d).select("id", *spatial.BOX)
    return spatial.pairs_once(b, "id", CELL, 0.05).withColumn("iou", F.round("iou", 6))


def _halves(b: DataFrame) -> tuple[DataFrame, DataFrame]:
    return b.filter("id div 500 % 2 = 0"), b.filter("id div 500 % 2 = 1")


@query("spatial_anti_join", f"WITH {BOX_SQL}, {_PAIR} SELECT id FROM box WHERE (id // 500) % 2 = 0 AND NOT EXISTS (SELECT 1 FROM iou WHERE a = box.id AND (b // 500) % 2 = 1 AND iou > 0.3)")
def _(spark, d):
    b = boxes(spark, d).select("id", *spatial.BOX)
    return spatial.spatial_anti_join(*_halves(b), "id", CELL, 0.3).select("id")


@query("export_overlap_anti_join", f"WITH {BOX_SQL}, {_PAIR} SELECT id FROM box WHERE (id // 500) % 2 = 0 AND NOT EXISTS (SELECT 1 FROM iou WHERE a = box.id AND (b // 500) % 2 = 1 AND iou >= 0.25)")
def _(spark, d):
    b = boxes(spark, d).select("id", *spatial.BOX)
    return spatial.spatial_anti_join(*_halves(b), "id", CELL, 0.25, inclusive=True).select("id")


@query("box_clip_fraction", f"WITH {BOX_SQL}, f AS (SELECT id, greatest(least(x1, 700) - greatest(x0, 200), 0) * greatest(least(y1, 800) - greatest(y0, 100), 0) / nullif((x1-x0)*(y1-y0), 0) AS f FROM box) SELECT id, round(f, 6) AS frac FROM f WHERE f >= 0.5")
def _(spark, d):
    return boxes(spark, d).withColumn("f", spatial.inside_fraction((200.0, 100.0, 700.0, 800.0))).filter("f >= 0.5").select("id", F.round("f", 6).alias("frac"))


@query("area_filter", f"WITH {BOX_SQL} SELECT id, (x1-x0)*(y1-y0) AS area FROM box WHERE (x1-x0)*(y1-y0) BETWEEN 100 AND 900")
def _(spark, d):
    return boxes(spark, d).withColumn("area", spatial.area()).filter(F.col("area").between(100, 900)).select("id", "area")


@query("self_max_iou", f"WITH {BOX_SQL}, {_PAIR} SELECT a AS id, round(max(iou), 6) AS max_iou FROM iou GROUP BY a")
def _(spark, d):
    return spatial.self_max_iou(boxes(spark, d).select("id", *spatial.BOX), "id", CELL).withColumn("max_iou", F.round("max_iou", 6))


@query("largest_per_species", f"WITH {BOX_SQL} SELECT species, id FROM (SELECT *, row_number() OVER (PARTITION BY species ORDER BY (x1-x0)*(y1-y0) DESC, id) AS r FROM box) WHERE r = 1")
def _(spark, d):
    return boxes(spark, d).groupBy("species").agg(F.max_by("id", F.struct(spatial.area().alias("a"), (-F.col("id")).alias("i"))).alias("id"))


@query("seed_filter", f"WITH {BOX_SQL} SELECT id, source FROM box WHERE nullif(source, '') IS NULL OR source IN ('seed', 'nesp')")
def _(spark, d):
    return boxes(spark, d).filter(lookup.is_seed(F.col("source"), (None, "seed", "nesp"))).select("id", "source")


@query("layer_counts", f"WITH {BOX_SQL} SELECT species, count(*) AS total, CAST(count_if(source IS DISTINCT FROM 'auto') AS BIGINT) AS hand, CAST(count_if(source IS NOT DISTINCT FROM 'auto') AS BIGINT) AS auto FROM box GROUP BY species")
def _(spark, d):
    auto = F.col("source").eqNullSafe("auto")
    return boxes(spark, d).groupBy("species").agg(F.count("*").alias("total"), F.count_if(~auto).alias("hand"), F.count_if(auto).alias("auto"))


@query("top_seed_layer", f"WITH {BOX_SQL} SELECT species, count(*) AS n FROM box WHERE source IS DISTINCT FROM 'auto' GROUP BY species ORDER BY n DESC, species DESC LIMIT 1")
def _(spark, d):
    return boxes(spark, d).filter(~F.col("source").eqNullSafe("auto")).groupBy("species").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("species")).limit(1)


@query("delete_auto", f"WITH {BOX_SQL} SELECT id, species FROM box WHERE source IS DISTINCT FROM 'auto'")
def _(spark, d):
    return boxes(spark, d).filter(~F.col("source").eqNullSafe("auto")).select("id", "species")


_ORD = "o AS (SELECT species, row_number() OVER (ORDER BY species) AS ordinal FROM (SELECT DISTINCT species FROM box) s)"


@query("rasterize_priority", f"WITH {BOX_SQL}, {_ORD}, c AS (SELECT id, species, source, unnest(range(CAST(x0 AS BIGINT), CAST(x1 AS BIGINT))) AS x, y0, y1 FROM box), g AS (SELECT *, unnest(range(CAST(y0 AS BIGINT), CAST(y1 AS BIGINT))) AS y FROM c) SELECT CAST(x AS INT) AS x, CAST(y AS INT) AS y, arg_max(g.species, (CASE WHEN source IS NULL OR source = 'seed' THEN 2 ELSE 1 END) * 1000 - ordinal) AS value FROM g JOIN o ON g.species = o.species GROUP BY x, y")
def _(spark, d):
    b = boxes(spark, d)
    band = F.when(F.col("source").isNull() | (F.col("source") == "seed"), 2.0).otherwise(1.0)
    order = b.select("species").distinct().withColumn("ordinal", F.row_number().over(Window.orderBy("species"))).withColumnRenamed("species", "o_species")
    width, height = (int(n or 0) for n in b.agg(F.max("x1"), F.max("y1")).first())
    return pixels.burn_boxes(b.join(F.broadcast(order), F.col("species") == F.col("o_species")), width, height, F.col("species"), band, F.col("ordinal"))


# --- names and exchange ------------------------------------------------------------------------------------

_KEY = r"""regexp_replace(trim(regexp_replace(lower(trim(regexp_replace({0}, '[_.\-]+', ' ', 'g'))), '\s+', ' ', 'g')), '^([^ ])[^ ]* (.*)$', '\1|\2')"""


@query("name_key", f"SELECT p_partkey AS id, CASE WHEN k LIKE '%|%' THEN k ELSE k || '|' END AS name_key FROM (SELECT p_partkey, {_KEY.format('p_name')} AS k FROM part) t")
def _(spark, d):
    return _table(spark, d, "part").select(F.col("p_partkey").alias("id"), names.name_key(F.col("p_name")).alias("name_key"))


_THEIRS = "(SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN 'E. minus' WHEN 1 THEN 'Poa_costiniana' WHEN 2 THEN 'Bog moss' WHEN 3 THEN 'C. gaudichaudiana' ELSE 'unknown thing' END AS theirs FROM part)"
CLASSES = ("Empidisma_minus", "Poa_costiniana", "Carex_gaudichaudiana", "Sphagnum")


def _theirs(spark, d):
    k = F.col("p_partkey") % 5
    name = F.when(k == 0, "E. minus").when(k == 1, "Poa_costiniana").when(k == 2, "Bog moss").when(k == 3, "C. gaudichaudiana").otherwise("unknown thing")
    return _table(spark, d, "part").select(F.col("p_partkey").alias("id"), name.alias("theirs"))


@query("name_map_join", f"SELECT id, theirs, CASE theirs WHEN 'E. minus' THEN 'Empidisma_minus' WHEN 'Poa_costiniana' THEN 'Poa_costiniana' WHEN 'Bog moss' THEN 'Sphagnum' WHEN 'C. gaudichaudiana' THEN 'Carex_gaudichaudiana' END AS ours FROM {_THEIRS} t")
def _(spark, d):
    classes = spark.createDataFrame([(c,) for c in CLASSES], "name string")
    return lookup.match_names(_theirs(spark, d), "theirs", classes, names.overrides(["bog moss=Sphagnum"], set(CLASSES)))


@query("to_theirs", "SELECT DISTINCT p_type, CASE WHEN p_type = 'SMALL' THEN 'learned' WHEN strpos(p_type || '_' || p_brand, '_') > 0 THEN upper(left(p_type, 1)) || '. ' || replace(p_brand, '_', ' ') END AS theirs, p_brand FROM part")
def _(spark, d):
    p = _table(spark, d, "part").select("p_type", "p_brand").distinct()
    name = F.concat_ws("_", "p_type", "p_brand")
    return p.select("p_type", "p_brand", F.when(F.col("p_type") == "SMALL", "learned").otherwise(lookup.to_theirs(name, {}, {})).alias("theirs"))


KNOWN = ("ECONOMY", "LARGE", "SMALL")


@query("guess_field", f"WITH c AS (SELECT count_if(p_type IN {KNOWN}) AS a, count_if(p_brand IN {KNOWN}) AS b FROM part) SELECT CASE WHEN a >= b THEN 'p_type' ELSE 'p_brand' END AS field, CAST(greatest(a, b) AS BIGINT) AS n FROM c")
def _(spark, d):
    return lookup.guess_field(_table(spark, d, "part"), ["p_type", "p_brand"], list(KNOWN))


@query("provenance_anti_join", "SELECT o_orderkey AS fid, 'nesp:f|' || o_orderstatus || '|' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_custkey % 3 <> 0 THEN '.' || CAST(o_custkey % 3 AS VARCHAR) ELSE '' END AS key FROM orders WHERE NOT (o_orderkey % 2 = 0 AND o_custkey % 3 = 0)")
def _(spark, d):
    o = _table(spark, d, "orders").withColumn("part", F.col("o_custkey") % 3)
    key = names.provenance(F.lit("f"), F.col("o_orderstatus"), F.col("o_orderkey"), F.col("part"))
    have = o.filter("o_orderkey % 2 = 0").select(names.provenance(F.lit("f"), F.col("o_orderstatus"), F.col("o_orderkey"), F.lit(0)).alias("have"))
    return o.select(F.col("o_orderkey").alias("fid"), key.alias("key")).join(have, F.col("key") == F.col("have"), "left_anti")


@query("export_log_anti_join", "SELECT o_orderkey AS fid, o_orderstatus AS layer FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linestatus = o.o_orderstatus)")
def _(spark, d):
    o = _table(spark, d, "orders").select(F.col("o_orderkey").alias("fid"), F.col("o_orderstatus").alias("layer"))
    log = _table(spark, d, "lineitem").select("l_orderkey", "l_linestatus")
    return o.join(log, (F.col("fid") == F.col("l_orderkey")) & (F.col("layer") == F.col("l_linestatus")), "left_anti")


@query("export_next_id", "SELECT o_orderkey, CAST((SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY o_orderstatus, o_orderkey) AS BIGINT) AS new_id FROM orders")
def _(spark, d):
    from fieldloom.sources.tables import Scratch

    rows = _table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return lookup.next_ids(rows, _table(spark, d, "part"), "p_partkey", ["o_orderstatus", "o_orderkey"], Scratch(spark)).select("o_orderkey", "new_id")


@query("export_reason_pivot", f"WITH {BOX_SQL} SELECT species, count(*) AS have, CAST(count_if(source = 'nesp') AS BIGINT) AS nesp, CAST(count_if(source IS DISTINCT FROM 'nesp' AND id % 3 = 0) AS BIGINT) AS logged, CAST(count_if(source IS DISTINCT FROM 'nesp' AND id % 3 <> 0 AND id % 5 = 0) AS BIGINT) AS overlap, CAST(count_if(source IS DISTINCT FROM 'nesp' AND id % 3 <> 0 AND id % 5 <> 0) AS BIGINT) AS send FROM box GROUP BY species")
def _(spark, d):
    why = lookup.reasons([("nesp", F.col("source").eqNullSafe("nesp")), ("logged", F.col("id") % 3 == 0), ("overlap", F.col("id") % 5 == 0)])
    r = boxes(spark, d).withColumn("why", why)
    return r.groupBy("species").agg(F.count("*").alias("have"), *[F.count_if(F.col("why") == w).alias(w) for w in ("nesp", "logged", "overlap", "send")])


@query("first_seen_report", "SELECT o_orderstatus AS theirs, count(*) AS n, CAST(count_if(o_totalprice > 100000) AS BIGINT) AS inside, min(o_orderkey) AS first FROM orders GROUP BY 1")
def _(spark, d):
    return _table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("theirs")).agg(F.count("*").alias("n"), F.count_if(F.col("o_totalprice") > 100000).alias("inside"), F.min("o_orderkey").alias("first"))


_HASH = "(event_id * 2654435761) % 4294967296"


@query("quota_sample", f"SELECT event_type, event_id, slot FROM (SELECT event_type, event_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY {_HASH}, event_id) AS INT) AS slot FROM events) WHERE slot <= 12")
def _(spark, d):
    e = _table(spark, d, "events").withColumn("h", F.expr(_HASH))
    return vectors.quota_sample(e, "event_type", F.struct("h", "event_id"), 12).select("event_type", "event_id", "slot")


@query("tile_pair_fallback", "WITH m AS (SELECT 't' || CAST(p_partkey AS VARCHAR) || CASE WHEN p_partkey % 4 = 0 THEN '_label' ELSE '' END AS name FROM part WHERE p_partkey % 3 <> 0 UNION SELECT 't' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 8 = 0), i AS (SELECT 't' || CAST(p_partkey AS VARCHAR) AS stem FROM part) SELECT stem, coalesce(a.name, b.name) AS mask FROM i LEFT JOIN m a ON a.name = stem || '_label' LEFT JOIN m b ON b.name = stem WHERE coalesce(a.name, b.name) IS NOT NULL")
def _(spark, d):
    p = _table(spark, d, "part")
    stem = F.concat(F.lit("t"), F.col("p_partkey").cast("string"))
    masks = p.filter("p_partkey % 3 <> 0").select(F.concat(stem, F.when(F.col("p_partkey") % 4 == 0, "_label").otherwise("")).alias("name"))
    return lookup.paired_tiles(p.select(stem.alias("stem")), masks.union(p.filter("p_partkey % 8 = 0").select(stem.alias("name"))).distinct())


@query("layers_semi_anti", "SELECT n_name AS layer, CASE WHEN EXISTS (SELECT 1 FROM region WHERE r_regionkey = n_regionkey AND r_name LIKE 'A%') THEN 'kept' ELSE 'ignored' END AS state FROM nation")
def _(spark, d):
    n, r = _table(spark, d, "nation"), _table(spark, d, "region").filter(F.col("r_name").startswith("A"))
    on = F.col("n_regionkey") == F.col("r_regionkey")
    part = lambda how, name: n.join(F.broadcast(r), on, how).select(F.col("n_name").alias("layer"), F.lit(name).alias("state"))
    return part("left_semi", "kept").unionByName(part("left_anti", "ignored"))


@query("resume_anti_join", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(spark, d):
    done = _table(spark, d, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey")
    return _table(spark, d, "orders").select("o_orderkey").join(done, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


@query("union_layers", f"WITH {BOX_SQL} SELECT id, species, source, CAST(NULL AS DOUBLE) AS score FROM box WHERE id % 2 = 0 UNION ALL SELECT id, species, NULL, x0 FROM box WHERE id % 2 = 1")
def _(spark, d):
    b = boxes(spark, d)
    one = b.filter("id % 2 = 0").select("id", "species", "source")
    return one.unionByName(b.filter("id % 2 = 1").select("id", "species", F.col("x0").alias("score")), allowMissingColumns=True)


@query("surviving_ids", f"WITH {BOX_SQL} SELECT id FROM box WHERE id % 2 = 0 INTERSECT SELECT id FROM box WHERE id % 3 = 0")
def _(spark, d):
    b = boxes(spark, d).select("id")
    return b.filter("id % 2 = 0").intersect(b.filter("id % 3 = 0"))


@query("part_index", "SELECT l_orderkey AS fid, l_linenumber AS raw_part, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS INT) AS part FROM lineitem WHERE l_quantity > 10")
def _(spark, d):
    rn = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")) - 1
    return _table(spark, d, "lineitem").filter("l_quantity > 10").select(F.col("l_orderkey").alias("fid"), F.col("l_linenumber").alias("raw_part"), rn.alias("part"))


@query("utm_zone", "SELECT c_custkey, CAST(CASE WHEN (c_custkey * 7) % 160 - 80 >= 0 THEN 32600 ELSE 32700 END + floor(((c_custkey * 13) % 360 - 180 + 180) / 6) + 1 AS BIGINT) AS epsg FROM customer")
def _(spark, d):
    lon, lat = (F.col("c_custkey") * 13) % 360 - 180, (F.col("c_custkey") * 7) % 160 - 80
    return _table(spark, d, "customer").select("c_custkey", geo.utm_epsg(lon, lat).alias("epsg"))


@query("pixel_size_m", "SELECT c_custkey, round((0.0001 * 111320 * cos(radians((c_custkey * 7) % 160 - 80)) + 0.0001 * 110540) / 2, 6) AS metres FROM customer")
def _(spark, d):
    lat = (F.col("c_custkey") * 7) % 160 - 80
    return _table(spark, d, "customer").select("c_custkey", F.round(geo.pixel_size_m(F.lit(0.0001), F.lit(-0.0001), lat, F.lit(True)), 6).alias("metres"))


@query("resolution_note", "SELECT p_partkey, CASE WHEN p_size / 25.0 < 0.98 THEN 'resample' WHEN p_size / 25.0 > 1.02 THEN 'coarser' ELSE 'keep' END AS note FROM part")
def _(spark, d):
    return _table(spark, d, "part").select("p_partkey", grid.resolution_note(F.col("p_size"), 25.0).alias("note"))


@query("long_names", "SELECT DISTINCT p_name AS name, CAST(length(p_name) AS INT) AS width FROM part WHERE length(p_name) > 8")
def _(spark, d):
    return _table(spark, d, "part").filter(F.length("p_name") > 8).select(F.col("p_name").alias("name"), F.length("p_name").alias("width")).distinct()


@query("tile_name_parse", "SELECT DISTINCT 'tile_r' || lpad(CAST(p_size AS VARCHAR), 4, '0') || '_c' || lpad(CAST(p_partkey % 97 AS VARCHAR), 4, '0') AS stem, CAST(p_size AS INT) AS r, CAST(p_partkey % 97 AS INT) AS c FROM part")
def _(spark, d):
    t = _table(spark, d, "part").select(grid.tile_name(F.col("p_size"), F.col("p_partkey") % 97).alias("stem")).distinct()
    r, c = grid.tile_of_name(F.col("stem"))
    return t.select("stem", r.alias("r"), c.alias("c"))
