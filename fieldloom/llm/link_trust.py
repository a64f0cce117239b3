"""URL filters by rules and link-graph propagation (operator 2).

Rules decide the pages they fit. Hosts with allowed pages are trusted seeds and hosts with blocked pages are
distrusted ones, each by the share of such pages. Trust flows along the links between hosts as a personalised
PageRank, distrust flows against them. Both are distributions: they sum to one over all hosts, however many seeds there
are, and what reaches a host without further links returns to the seeds (which, as ranks are linear, is the same as
dividing by the sum in the end). A page that no rule fits takes its host's verdict: block if the host's
distrust exceeds its trust by more than ``MARGIN``.

Ranks are iterated until ``SAVE_EVERY`` rounds reach no new host and change no host's rank by more than ``TOLERANCE`` of
it, however many rounds that takes: a chain of links takes as many as it is long. Ranks that would fall below ``FLOOR``
are held there, so that even a host thousands of links from a seed is told from one that no seed reaches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Scratch

#: (verdict, rule): the part before the first slash is the host, the rest is the path's beginning.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
DAMPING, TOLERANCE, FLOOR, SAVE_EVERY, MARGIN = 0.85, 1e-9, 1e-300, 4, 0.0
#: After so many rounds the damping alone leaves less than ``TOLERANCE`` of the start. Not a bound of the loop; plain versions use it.
ROUNDS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"""(?i)\shref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits a host (or a parent domain of it) and the beginning of its path."""
    out = None
    for _, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, tail = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return out if out is not None else F.lit(None).cast("string")


def verdict_of(rule: Column, rules=RULES) -> Column:
    out = F.when(F.lit(False), "")
    for verdict, name in rules:
        out = out.when(rule == name, verdict)
    return out


def host_edges(pages: DataFrame, host: str, html: str) -> DataFrame:
    """(src, dst, weight): pages of one host that link to another."""
    linked = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(_HREF), F.lit(1)), lambda u: F.translate(F.regexp_extract(u, r"^[^/]*//([^/?#]*)", 1), _UPPER, _LOWER)))
    e = pages.select(F.col(host).alias("src"), linked.alias("all")).filter(F.size("all") > 0).select("src", F.explode("all").alias("dst"))
    return e.filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def spread(seeds: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, rank): personalised PageRank of (host, seed) rows along (src, dst, share) rows, to within ``TOLERANCE``.

    Ranks sum to one. Without edges, or without seeds, what the seeds hold stays with them.
    """
    if edges.isEmpty():
        return _normalised(seeds.select("host", F.col("seed").alias("rank")))
    rank = last = seeds.select("host", F.col("seed").alias("rank"))
    home = seeds.select("host", (F.col("seed") * (1 - DAMPING)).alias("part"))
    while True:
        for _ in range(SAVE_EVERY):
            flow = edges.join(rank, edges.src == rank.host).groupBy(F.col("dst").alias("host")).agg(F.sum(F.col("share") * F.col("rank") * DAMPING).alias("part"))
            rank = flow.unionByName(home).groupBy("host").agg(F.greatest(F.sum("part"), F.lit(FLOOR)).alias("rank"))
        rank = scratch.save(rank)
        old = last.select(F.col("host").alias("o_host"), F.col("rank").alias("o_rank"))
        moved = rank.join(old, F.col("host") == F.col("o_host"), "left").filter(F.col("o_rank").isNull() | (F.abs(F.col("rank") - F.col("o_rank")) > F.col("rank") * TOLERANCE))
        still = moved.isEmpty()
        scratch.drop(last)
        if still:
            return _normalised(rank)
        last = rank


def _normalised(rank: DataFrame) -> DataFrame:
    total = rank.agg(F.sum("rank")).first()[0]
    return rank.withColumn("rank", F.col("rank") / F.lit(total or 1.0))


def shares(edges: DataFrame) -> DataFrame:
    out = edges.groupBy(F.col("src").alias("o_src")).agg(F.sum("weight").alias("total"))
    return edges.join(out, F.col("src") == F.col("o_src")).select("src", "dst", (F.col("weight") / F.col("total")).alias("share"))


def host_scores(pages: DataFrame, scratch: Scratch, host: str = "host", html: str = "html", verdict: str = "rule_verdict") -> DataFrame:
    """(host, trust, distrust) of every host that a seed reaches; a table without links spreads nothing."""
    seeds = pages.filter(F.col(host) != "").groupBy(F.col(host).alias("host")).agg(
        F.avg(F.when(F.col(verdict) == "allow", 1.0).otherwise(0.0)).alias("good"),
        F.avg(F.when(F.col(verdict) == "block", 1.0).otherwise(0.0)).alias("bad"),
    )
    seeds = scratch.save(seeds.filter("good > 0 or bad > 0"))
    edges = scratch.save(host_edges(pages, host, html))
    good = seeds.select("host", F.col("good").alias("seed")).filter("seed > 0")
    bad = seeds.select("host", F.col("bad").alias("seed")).filter("seed > 0")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    along, against = scratch.save(shares(edges)), scratch.save(shares(back))
    trust, distrust = spread(good, along, scratch), spread(bad, against, scratch)
    both = trust.select("host", F.col("rank").alias("trust"), F.lit(0.0).alias("distrust")).unionByName(distrust.select("host", F.lit(0.0).alias("trust"), F.col("rank").alias("distrust")))
    out = scratch.save(both.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")))
    scratch.keep_only(out)
    return out


def judge(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) of every page.

    A null url, or one without ``://``, has an empty host and path, seeds nothing and is allowed; a null html has no links.
    Repeated rows stay, and each counts in its host's shares and links. Equal trust and distrust, none included, allow. An
    empty table gives no rows. Urls and html of any length are read whole; only the three named columns are read, so others may
    have any names. A host with very many links is split by Spark's handling of skewed joins, and its links are summed up
    before they are shuffled.
    """
    scratch = Scratch(df.sparkSession)
    pages = df.select(F.col(id_col).alias("p_id"), F.col(url_col).alias("p_url"), F.col(html_col).alias("html"))
    pages = pages.withColumn("host", host_of(F.col("p_url"))).withColumn("path", path_of(F.col("p_url"))).drop("p_url")
    pages = pages.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("rule_verdict", verdict_of(F.col("rule"), rules))
    score = host_scores(pages, scratch).withColumnRenamed("host", "s_host")
    out = pages.drop("html").join(score, F.col("host") == F.col("s_host"), "left")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    method = F.when(distrust - trust > MARGIN, "block").otherwise("allow")
    return out.select(F.col("p_id").alias(id_col), "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
