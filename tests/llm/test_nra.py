"""NRA against scores of all documents."""

import math
import random
import re
from collections import Counter

import fixtures
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from firstlight.llm import nra

ITEMS = T.StructType([T.StructField(n, t) for n, t in (("item_id", T.StringType()), ("text", T.StringType()), ("query", T.LongType()), ("score", T.StringType()))])


def terms(text):
    return re.findall(nra.TERM, (text or "").translate(fixtures.UPPER))


def plain(rows, items, k=10):
    docs = [(i, Counter(terms(t))) for i, t, _ in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total, df = sum(n for _, _, n in docs), Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in docs:
            m = 10 + 90 * n * len(docs) // total
            w = lambda t: math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


QUERIES = [
    ("a", "The river, the LIGHT!"), ("b", "état naïve 42"), ("none", "zzzz unheard"), ("null", None), ("empty", " \n"), ("twice", "over stone"),
    ("twice", "over stone"), (None, "thing of"), ("long", fixtures.sentence(random.Random(1), 3000)), ("hot", "the and of thing over river stone light"),
]


def found(spark, rows, items, **kw):
    items = spark.createDataFrame([(i, t, 7, "clash") for i, t in items], ITEMS)
    return fixtures.rows_of(nra.search(fixtures.docs(spark, rows), items, **kw), "item_id", "rank", "doc_id", "score")


@pytest.mark.parametrize("kw", [{}, {"k": 1}, {"k": 1000}, {"block_terms": 4}])
def test_search(spark, kw):
    rows = fixtures.texts()
    assert found(spark, rows, QUERIES, **kw) == plain(rows, QUERIES, kw.get("k", 10))


def test_empty_tables(spark):
    assert found(spark, [], QUERIES) == found(spark, fixtures.texts(), []) == []
    assert found(spark, [(1, None, None), (2, "", None)], QUERIES) == []
    assert nra.search(fixtures.docs(spark, []), spark.createDataFrame([], ITEMS)).columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, "one two", None) for i in (9, 3, 7, 5, 1, 8)] + [(None, "one two", None), (20, "three", None)] + [(i, "other words", None) for i in range(30, 50)]
    got = found(spark, rows, [("q", "one")], k=4)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == [1, 3, 5, 7]


def test_reading_stops_early_and_is_exact():
    rng = np.random.default_rng(3)
    n_docs, n_terms, k = 5000, 12, 10
    for trial in range(10):
        held = rng.random((n_docs, n_terms)) < rng.uniform(0.05, 0.9, n_terms)
        sizes = held.sum(axis=1)
        piece = nra.Piece(rng.integers(1, 400, n_docs), sizes, np.nonzero(held)[1], rng.integers(1, 9, sizes.sum()), rng.integers(0, 4000, n_terms), n_docs, 200 * n_docs)
        scores = np.zeros(n_docs, dtype=np.int64)
        np.add.at(scores, piece.doc, piece.impact)
        floor = int(np.sort(scores)[-3]) if trial % 2 else 0
        at, got = piece.best(np.arange(n_terms), k, floor)
        least = max(1, floor, int(np.sort(scores)[-k]))
        assert at.tolist() == np.flatnonzero(scores >= least).tolist() and got.tolist() == scores[at].tolist()


def test_pieces_are_bounded_and_whole(monkeypatch):
    monkeypatch.setattr(nra, "PIECE_DOCS", 7)
    monkeypatch.setattr(nra, "PIECE_POSTINGS", 20)
    rng = random.Random(2)
    lists = [[rng.randrange(100) for _ in range(rng.choice([1, 2, 5, 30]))] for _ in range(60)]
    batch = lambda at: pa.RecordBatch.from_pydict(
        {"doc_id": pa.array(at), "n": pa.array(at), "terms": pa.array([lists[i] for i in at], pa.list_(pa.int32())), "tf": pa.array([lists[i] for i in at], pa.list_(pa.int64()))}
    )
    pieces = list(nra._pieces([batch(list(range(a, min(a + 13, 60)))) for a in range(0, 60, 13)]))
    assert [i for p in pieces for i in p[0].to_pylist()] == list(range(60))
    for ids, n, sizes, of, tf in pieces:
        assert of.tolist() == tf.tolist() == [t for i in ids.to_pylist() for t in lists[i]]
        assert len(ids) <= 7 and (len(ids) == 1 or sizes.sum() <= 20)
