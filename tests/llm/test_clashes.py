"""Stages over documents whose other columns have the names that the stages use themselves."""

import fixtures
import pytest
from pyspark.sql import functions as F

from firstlight.llm import decontam, exact_dedup, jaccard_join, sentencepieces

NAMES = ["text_sha256", "stay_id", "STAY_SHA", "own_sha", "_own_sha", "_sha", "hit_id", "hit_text", "kept", "ids", "lossless", "key_id", "w", "n_hit"]
BENCHMARK = [(1, "the and of thing over river stone light the and"), (2, None)]


@pytest.fixture(scope="module")
def clashing(spark):
    docs = fixtures.docs(spark)
    wide = docs.select("doc_id", "text", "lang", *[F.lit(f"own {n}").alias(n) for n in NAMES])
    return wide, docs.select("doc_id", "text", "lang")


STAGES = {
    "copies": lambda spark, docs: exact_dedup.without_copies(docs, bucket_keys=4),
    "near": lambda spark, docs: jaccard_join.one_of_each(docs, width=2, threshold=80),
    "benchmark": lambda spark, docs: decontam.without_benchmark(docs, spark.createDataFrame(BENCHMARK, "item_id long, text string")),
}


@pytest.mark.parametrize("name", STAGES)
def test_stage(spark, clashing, name):
    wide, narrow = clashing
    got, want = STAGES[name](spark, wide), STAGES[name](spark, narrow)
    assert got.columns == wide.columns
    rows = got.collect()
    assert sorted((repr(r["doc_id"]), repr(r["text"])) for r in rows) == sorted((repr(r["doc_id"]), repr(r["text"])) for r in want.collect())
    assert all(r[n] == f"own {n}" for r in rows for n in NAMES)


def test_kept_columns_of_an_encoding(spark, clashing):
    wide, _ = clashing
    found = sentencepieces.encode(wide.filter("length(text) < 500"), fixtures.path("piece_bpe_32k.model"), keep=["lang", "ids", "lossless", "text"], checked=True)
    assert found.columns == ["doc_id", "text", "lang", "kept_ids", "kept_lossless", "kept_text", "ids", "lossless"]
    for r in found.collect():
        assert r["kept_ids"] == "own ids" and r["kept_lossless"] == "own lossless" and r["kept_text"] == r["text"] and r["lossless"]
