"""A training-data pipeline over ``documents``: each stage works on what the one before it kept.

Every stage takes an empty table and gives one; columns beside those it names, whatever they are called, pass through all
but the last; very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import language_id, lexicon_bpe, minmax_dedup, mixing, pii_crf
from fieldloom.llm.common import Scratch, table
from fieldloom.llm.queries import tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null and empty texts among them), or whose language is ambiguous, go. Repeated rows fare alike."""
    return language_id.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates stays, with all rows of that id; rows without an id or without words stay."""
    return minmax_dedup.drop_near_duplicates(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text. Null texts stay null, repeated rows stay."""
    return pii_crf.redact_documents(docs, chars_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document appears as often as the mix takes it. A null source is one; null and empty texts count no words but are taken at their source's rate."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids binary, decoded string, n_tokens) of every copy; null texts are empty."""
    ids = lexicon_bpe.encode_documents(docs, tokenizer("word_bpe_49k.json"))
    return ids.withColumn("n_tokens", (F.length("ids") / 4).cast("long"))


STAGES = [("language", language), ("near_dedup", near_dedup), ("pii", pii), ("mix", mix), ("encode", encode)]

#: SQL can't express the language model, so a brute-force version in the tests stands in for it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's table is removed once the next one has been written."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for _, stage in STAGES[:-1]:
        last, docs = docs, scratch.save(stage(spark, docs, sf_dir))
        scratch.drop(last)
    return STAGES[-1][1](spark, docs, sf_dir)
