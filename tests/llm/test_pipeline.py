"""The pipeline against a plain version of its stages, and on odd tables."""

import collections

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_operators import ODD, SCHEMA, components, library

import corpus_pipeline
from fieldloom.llm import language_id, mixing, pii_crf, queries


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, seen[-1], SF).write.parquet(str(tmp_path / str(k)))
        seen.append(spark.read.parquet(str(tmp_path / str(k))))
    rows = [{r["doc_id"]: r for r in d.collect()} for d in seen]
    assert all(d.columns == docs.columns for d in seen[:-1])
    flagged = {r["doc_id"] for r in language_id.identify(docs).filter("ambiguous").collect()}
    assert set(rows[1]) == set(rows[0]) - flagged
    comp, _ = components([(k, r["text"]) for k, r in rows[1].items()])
    assert set(rows[2]) == {k for k in comp if comp[k] == k}
    w = pii_crf.trained()
    assert {k: (r["text"], r["n_chars"]) for k, r in rows[3].items()} == {k: (t := pii_crf.redacted(r["text"], w), len(t)) for k, r in rows[2].items()}
    assert any("<EMAIL>" in r["text"] for r in rows[3].values())
    n = collections.Counter(r["doc_id"] for r in seen[4].collect())
    assert all(n[r["doc_id"]] * r["size"] == r["taken"] for r in mixing.mix_report(seen[3]).collect())
    t = library(queries.tokenizer("word_bpe_49k.json"))
    for r in seen[5].collect():
        ids = t.encode(rows[4][r["doc_id"]]["text"], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids) and r["decoded"] == t.decode(ids, skip_special_tokens=False)
    whole = collections.Counter(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect())
    assert whole == n


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, tmp_path, empty):
    df = spark.createDataFrame([] if empty else ODD, SCHEMA).withColumn("n_chars", F.char_length("text")).withColumn("id", F.lit(1)).withColumn("key", F.lit("k"))
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, df, SF).write.parquet(str(tmp_path / str(k)))
        new = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert new.columns == df.columns
        df = new
    assert (df.count() == 0) == empty
