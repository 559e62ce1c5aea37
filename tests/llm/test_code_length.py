"""Code length per byte of the context tree."""

import math

import fixtures
from pyspark.sql import functions as F

from firstlight.llm import context_tree


def test_bits_per_byte(spark):
    rows = [(1, "abra cadabra", None), (2, "é", None), (3, "", None), (4, None, None), (5, "Abra", None)]
    got = {r["doc_id"]: r for r in context_tree.score_held_out(fixtures.docs(spark, rows)).collect()}
    for i, text, _ in rows:
        n = len((text or "").encode())
        assert got[i]["n_bytes"] == n
        assert math.isclose(got[i]["bits_per_byte"], -got[i]["score"] / math.log10(2) / (n + 1))


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    rows = [(i, f"abra cadabra {i % 7} simsalabim {'é' * (i % 3)}", None) for i in range(40)]
    score = lambda: {r["doc_id"]: r for r in context_tree.score_held_out(fixtures.docs(spark, rows)).collect()}
    one = score()
    monkeypatch.setattr(context_tree, "BLOCK_BYTES", 200)
    monkeypatch.setattr(context_tree, "TOGETHER", 20)
    monkeypatch.setattr(context_tree, "HELD", 30)
    many = score()
    assert one.keys() == many.keys() == set(range(40))
    for i in one:
        assert math.isclose(one[i]["score"], many[i]["score"], rel_tol=1e-6) and math.isclose(one[i]["base_score"], many[i]["base_score"], rel_tol=1e-9)


def test_pairs_are_asked_once_a_block(spark):
    """Texts that share their pairs add none to what is moved; before, each text had rows of its own."""

    def asked(copies):
        rows = fixtures.docs(spark, [(i, "the quick brown fox jumps over the lazy dog", None) for i in range(copies)])
        blocks, n = context_tree._in_blocks(rows.select("doc_id", "text", F.lit(True).alias("learn"), F.lit(True).alias("asked")))
        return context_tree._requests(blocks, n).select(F.inline("asked")).agg(F.sum("size")).first()[0]

    assert asked(1) == asked(200) == 44
