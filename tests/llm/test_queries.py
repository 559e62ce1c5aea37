"""Registered queries against their SQL, and the pipeline against its stages applied plainly."""

import os

import oracle
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from firstlight.llm import decontam, exact_dedup, jaccard_join, toxicity
from firstlight.llm.queries import ORACLE_SQL, QUERIES
from firstlight.llm.tables import table

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_all_are_registered():
    names = set(entry_point.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(ORACLE_SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert oracle.difference(QUERIES[name](spark, SF), oracle.connect(SF), ORACLE_SQL[name]) is None


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    labels = table(spark, SF, "labels")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out(labels)))
    left = docs.join(toxicity.score(docs, model).filter("predicted = 0").select("doc_id"), "doc_id")
    left = left.join(exact_dedup.dedup(left).filter("kept").select("doc_id"), "doc_id")
    left = left.join(jaccard_join.groups(left, 5, 80).filter("doc_id = component_id").select("doc_id"), "doc_id")
    left = left.join(decontam.decontaminate(left, table(spark, SF, "benchmark")).filter("not contaminated").select("doc_id"), "doc_id")
    got = corpus_pipeline.run(spark, SF)
    assert ids(got) == ids(left) and 0 < got.count() < docs.count()
    assert got.filter("not lossless").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "decontamination", "sentencepiece"]
