"""Rows that no copy, near copy or benchmark window concerns are not shuffled; screens lose no key."""

import fixtures
import pytest
from pyspark.sql import functions as F

from firstlight.llm import decontam, exact_dedup, jaccard_join, tables

TEXTS = [(i, f"text {i} of its own " * 3, "en") for i in range(40)]
COPIES = [(100, TEXTS[3][1], "en"), (101, TEXTS[3][1].upper(), "en"), (None, TEXTS[4][1], "en"), (5, TEXTS[5][1], "en"), (6, "another text", "en")]

STAGES = {
    "copies": lambda spark, docs: exact_dedup.without_copies(docs),
    "near": lambda spark, docs: jaccard_join.one_of_each(docs, width=2, threshold=80),
    "benchmark": lambda spark, docs: decontam.without_benchmark(docs, spark.createDataFrame([(1, "text 7 of its own")], "item_id long, text string")),
}


@pytest.mark.parametrize("most", [1 << 26, 1 << 15])
def test_screen_loses_no_key(spark, monkeypatch, most):
    """Also with so few bits that most other rows are let through."""
    monkeypatch.setattr(tables, "SCREEN_BITS", most)
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("a"), F.col("id").alias("screen_block"))
    wanted = rows.filter("screen_block % 2 = 0").select("a")
    out, met = tables.screened(rows, [F.col("a")], wanted)
    assert out.columns == met.columns == rows.columns
    assert out.filter("screen_block % 2 = 0").count() == 0
    assert met.filter("screen_block % 2 = 0").count() == 10_000
    assert out.count() + met.count() == 20_000
    assert out.count() > (9_900 if most > 1 << 20 else 1_000)
    none, all_of = tables.screened(rows, [F.col("a")], wanted.limit(0))[::-1]
    assert none.count() == 0 and all_of.count() == 20_000


@pytest.mark.parametrize("name", STAGES)
def test_only_concerned_texts_are_shuffled(spark, name):
    """Each stage hands on the rows that nothing concerns as they are."""
    docs = tables.stored(fixtures.docs(spark, TEXTS + COPIES), "screens")
    kept = STAGES[name](spark, docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    unconcerned = plan[plan.index("Union") :].split("\n   :- ")[1].split("\n   +- ")[0]
    assert "Exchange hashpartitioning" not in unconcerned
    if name == "copies":
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted([i for i in range(40) if i != 3] + [6, 101])
