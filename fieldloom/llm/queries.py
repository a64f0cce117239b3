"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import fuzzy_hash, language_id, lexicon_bpe, link_trust, minmax_dedup, mixing, multi_index, pii_crf, secret_scan, token_counts
from fieldloom.llm.common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(f: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {
        "op1_document_fingerprints": _documents(fuzzy_hash.fingerprint_documents),
        "op2_url_filters": lambda spark, d: link_trust.judge(table(spark, d, "pages")),
        "op3_bpe_encoding": _documents(lambda df: lexicon_bpe.encode_digests(df, tokenizer("word_bpe_49k.json"))),
        "op4_minhash_near_dedup": _documents(minmax_dedup.near_duplicates),
        "op5_nearest_neighbours": lambda spark, d: multi_index.search(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0),
        "op6_secret_scans": _documents(secret_scan.scan_documents),
        "op7_language_id": _documents(language_id.identify),
        "op8_token_counts": _documents(lambda df: token_counts.count_documents(df, tokenizer("byte_bpe_50k.json"))),
        "op9_pii": _documents(pii_crf.pii_documents),
        "op10_mixing": _documents(mixing.mix_report),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_minhash_near_dedup": minmax_dedup.NEAR_SQL, "op10_mixing": mixing.REPORT_SQL}
