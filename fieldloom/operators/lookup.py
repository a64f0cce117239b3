"""Lookup joins, name matching, cascades and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.functions import names

MANUAL = (None, "seed")


def map_classes(df: DataFrame, mapping: dict[int, int], cluster: Column, default: int = 0) -> Column:
    """The class of a cluster by a small map; clusters without one are background."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), cluster), F.lit(default))


def named_classes(rows: DataFrame, classes: DataFrame, name: str = "species") -> DataFrame:
    """(cluster_id, class_id); blank names mean background, and all unknown ones are reported at once."""
    found = rows.withColumn("n_name", names.clean(F.col(name))).join(F.broadcast(classes.select("class_id", F.col("name").alias("c_name"))), F.col("n_name") == F.col("c_name"), "left")
    bad = [r["n_name"] for r in found.filter("class_id is null").select("n_name").distinct().orderBy("n_name").collect()]
    if bad:
        raise ValueError(f"unknown names: {', '.join(bad)}")
    return found.select("cluster_id", "class_id")


def is_seed(source: Column, sources: tuple = (None, "seed", "auto", "nesp")) -> Column:
    """Whether a polygon's origin is among ``sources``; an empty string counts as none."""
    known = [s for s in sources if s is not None]
    s = F.nullif(source, F.lit(""))
    return F.coalesce(s.isin(known), F.lit(None in sources))


def match_names(df: DataFrame, theirs: str, classes: DataFrame, overrides: dict[str, str]) -> DataFrame:
    """Add ``ours``: an override, else the exact name, else the loose key (of classes of one key the last counts: the largest ``class_id``, or name without one)."""
    over = F.element_at(F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv]), F.lower(F.trim(F.col(theirs)))) if overrides else F.lit(None).cast("string")
    exact = classes.select(F.col("name").alias("e_name")).distinct()
    place = F.col("class_id") if "class_id" in classes.columns else F.lit(0)
    keyed = classes.select(names.name_key(F.col("name")).alias("k_key"), "name", place.alias("place")).groupBy("k_key").agg(F.max_by("name", F.struct("place", "name")).alias("k_name"))
    # classes are few; else rows would be shuffled by their names, of which some are frequent
    keys = df.withColumn("m_name", F.trim(F.col(theirs))).withColumn("m_key", names.name_key(F.col(theirs)))  # once a row; a join's own key is worked out again for each use of its parts
    out = keys.join(F.broadcast(exact), F.col("m_name") == F.col("e_name"), "left").join(F.broadcast(keyed), F.col("m_key") == F.col("k_key"), "left")
    return out.withColumn("ours", F.coalesce(over, "e_name", "k_name")).drop("e_name", "k_key", "k_name", "m_name", "m_key")


def learned_spelling(df: DataFrame, theirs: str, order: list[str], classes: DataFrame, overrides: dict[str, str]) -> DataFrame:
    """(species, spelling): how the other side spells each class, by the first row that names it."""
    named = match_names(df, theirs, classes, overrides).filter("ours is not null")
    return named.groupBy(F.col("ours").alias("species")).agg(F.min_by(F.trim(F.col(theirs)), F.struct(*order)).alias("spelling"))


def to_theirs(name: Column, learned: dict[str, str], overrides: dict[str, str]) -> Column:
    pick = lambda m: F.element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), name) if m else F.lit(None).cast("string")
    return F.coalesce(pick(learned), pick(overrides), names.abbreviated(name))


def guess_field(df: DataFrame, fields: list[str], known: list[str]) -> DataFrame:
    """(field, n): the column with most recognised values, the first of equals; null if nothing is recognised."""
    counts = df.agg(*[F.count_if(F.col(f).isin(known)).alias(f) for f in fields])
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("n"), F.lit(-i).alias("o")) for i, f in enumerate(fields)])).alias("r")
    best = counts.select(rows).select("r.*").agg(F.max(F.struct("n", "o", "field")).alias("b"))
    return best.select(F.when(F.col("b.n") > 0, F.col("b.field")).alias("field"), F.col("b.n").alias("n"))


def numbered(rows: DataFrame, order: list, scratch, name: str = "rank") -> DataFrame:
    """Rows with their 1-based place in the order, without sorting them in one task.

    Rows are dealt to ranges of the order and written, so that the ranges stay fixed; ranges are counted, and a row's place
    is its place in its range after the sizes of the earlier ranges. Ranges are numbered in order, so only their counts,
    one per task, are summed in one place. ``order`` must tell any two rows apart.
    """
    dealt = scratch.save(rows.repartitionByRange(*order).withColumn("n_range", F.spark_partition_id()))
    sizes = dealt.groupBy("n_range").agg(F.count("*").alias("n_size"))
    before = F.coalesce(F.sum("n_size").over(Window.orderBy("n_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("n_range").alias("s_range"), before.alias("n_start"))
    placed = dealt.withColumn("n_place", F.row_number().over(Window.partitionBy("n_range").orderBy(*order)))
    out = placed.join(F.broadcast(starts), F.col("n_range") == F.col("s_range"))
    return out.withColumn(name, F.col("n_start") + F.col("n_place")).drop("n_range", "s_range", "n_start", "n_place")


def next_ids(rows: DataFrame, target: DataFrame, id_col: str, order: list, scratch) -> DataFrame:
    """Rows with ids that go on after the target's largest, in the given order."""
    top = target.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top_id"))
    return numbered(rows, order, scratch, "i_rank").crossJoin(F.broadcast(top)).withColumn("new_id", F.col("top_id") + F.col("i_rank")).drop("i_rank", "top_id")


def reasons(cascade: list[tuple[str, Column]], otherwise: str = "send") -> Column:
    """The first reason whose condition holds."""
    out = None
    for name, cond in cascade:
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(otherwise) if out is not None else F.lit(otherwise)


def paired_tiles(images: DataFrame, masks: DataFrame) -> DataFrame:
    """(stem, mask): each image's ``<stem>_label`` mask, else the one of its own name; images without any go."""
    a = masks.select(F.col("name").alias("a_name"))
    b = masks.select(F.col("name").alias("b_name"))
    out = images.join(a, F.concat("stem", F.lit("_label")) == F.col("a_name"), "left").join(b, F.col("stem") == F.col("b_name"), "left")
    return out.withColumn("mask", F.coalesce("a_name", "b_name")).filter("mask is not null").select("stem", "mask")
