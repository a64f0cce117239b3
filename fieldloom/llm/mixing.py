"""Mixing sources to target weights (operator 10), with DataFrame functions only.

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share the total number of words. A target
stops at ``CEILING`` times its source's size; what is left over goes to the others by weight until none is above.
That is water-filling: with sources sorted by ceiling / weight, a source is full exactly if its ceiling is at
most its weighted share of what the fuller ones before it leave. So two running sums over one row per source
replace the rounds. A document is then taken floor(rate) times, plus once more if a uniform number made from the
seed and its id falls below the fraction; a rerun makes the same choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5, 2, 1)
CEILING = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(m_source, m_source_size, m_target) from rows with m_source and m_size."""
    per = sizes.groupBy("m_source").agg(F.sum("m_size").alias("m_source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("m_source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int")).cast("double")
    every = Window.partitionBy()
    fuller = Window.orderBy("m_ratio", F.col("m_source").asc_nulls_last())
    before = fuller.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("m_weight", weight).withColumn("m_cap", (F.col("m_source_size") * CEILING).cast("double"))
    per = per.withColumn("m_ratio", F.col("m_cap") / F.col("m_weight"))
    per = per.withColumn("m_left", F.sum(F.col("m_source_size").cast("double")).over(every) - F.coalesce(F.sum("m_cap").over(before), F.lit(0.0)))
    per = per.withColumn("m_heft", F.sum("m_weight").over(every) - F.coalesce(F.sum("m_weight").over(before), F.lit(0.0)))
    per = per.withColumn("m_full", F.col("m_cap") * F.col("m_heft") <= F.col("m_weight") * F.col("m_left"))
    level = F.max(F.when(~F.col("m_full"), F.struct(-F.col("m_ratio"), F.col("m_left") / F.col("m_heft")).alias("l"))).over(every)
    per = per.withColumn("m_level", level)
    return per.select("m_source", "m_source_size", F.when(F.col("m_full"), F.col("m_cap")).otherwise(F.col("m_weight") * F.col("m_level.col2")).alias("m_target"))


def _copies(seed: str) -> Column:
    rate = F.when(F.col("m_source_size") > 0, F.col("m_target") / F.col("m_source_size")).otherwise(F.lit(0.0))
    key = F.concat_ws("/", F.lit(seed), F.coalesce(F.col("m_id").cast("string"), F.lit("null")))
    uniform = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return (F.floor(rate) + F.when(uniform < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def with_copies(sizes: DataFrame, seed: str = SEED) -> DataFrame:
    """Add m_source_size, m_target and m_copies to rows with m_id, m_source and m_size."""
    t = targets(sizes).withColumnRenamed("m_source", "t_source")
    out = sizes.join(t, F.col("m_source").eqNullSafe(F.col("t_source")), "left").drop("t_source")
    return out.withColumn("m_copies", _copies(seed))


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return df.select(F.col(id_col).alias("m_id"), F.col(source_col).alias("m_source"), word_count(F.col(text_col)).alias("m_size"))


def mix_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """(id, size, source_size, target, taken) per document.

    A null or empty text has no words and takes none; a null source is a source, the last; a source without words has target 0.
    Rows of equal id are taken alike, repeated rows each count; an empty table gives no rows. A very long text is counted
    whole. Only the three named columns are read, so others may have any names. The windows without a partition run over one row
    per source, which one task holds as long as sources are fewer than millions.
    """
    out = with_copies(sized(df, id_col, text_col, source_col), seed)
    return out.select(
        F.col("m_id").alias(id_col), F.col("m_size").alias("size"), F.col("m_source_size").alias("source_size"),
        F.col("m_target").alias("target"), (F.col("m_size") * F.col("m_copies")).alias("taken"),
    )


def mix_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """The documents themselves, each as many times as the mix takes it, with the columns of ``df``."""
    names = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("m_row")
    out = df.select(row, F.col(id_col).alias("m_id"), F.col(source_col).alias("m_source"))
    light = targets(sized(df, id_col, text_col, source_col)).withColumnRenamed("m_source", "t_source")
    out = out.join(light, F.col("m_source").eqNullSafe(F.col("t_source")), "left").withColumn("m_copies", _copies(seed))
    return out.filter("m_copies > 0").select("m_row", F.explode(F.array_repeat(F.lit(0), F.col("m_copies").cast("int")))).select("m_row.*")


#: The same mix in SQL, for tables named by ``{documents}``.
REPORT_SQL = r"""
WITH s AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM s GROUP BY source),
w AS (SELECT source, source_size, CAST(CASE r % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS cap FROM p),
o AS (SELECT *, cap / weight AS ratio FROM w),
c AS (SELECT *, sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
  sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS heft FROM o),
f AS (SELECT *, cap * heft <= weight * lft AS is_full FROM c),
l AS (SELECT lft / heft AS level FROM f WHERE NOT is_full ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE weight * (SELECT level FROM l) END AS target FROM f),
d AS (SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
  CAST(CAST('0x' || substr(md5('mix-1/' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM d
"""
