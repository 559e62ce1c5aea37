"""Intermediate tables go when nothing reads them any more; learned shingles need no sets to be moved."""

import os

import fixtures
import pyarrow as pa
import pytest
from test_links import passages
from test_sets import plain_groups

from firstlight.llm import jaccard_join, tables
from firstlight.session import scratch_dir


def test_near_copies_leave_one_table(spark):
    folder = os.path.dirname(scratch_dir(spark, "here")).removeprefix("file:")
    jaccard = lambda: {f for f in os.listdir(folder) if f.startswith("jaccard")} if os.path.isdir(folder) else set()
    before = jaccard()
    kept = jaccard_join.one_of_each(fixtures.docs(spark, passages(2)))
    assert [f.partition("-")[2].partition("-")[0] for f in jaccard() - before] == ["kept"]
    assert kept.count() == 24


@pytest.mark.parametrize("room", [0, 40, 1 << 20])
def test_learned_shingles_in_a_table_and_beyond_it(spark, monkeypatch, room):
    """An index that grows with the corpus and all groups, whether tasks hold all learned shingles, some or none."""
    monkeypatch.setattr(jaccard_join, "MOST_LEARNED", room)
    rows = passages(3)
    index = jaccard_join._indexed(fixtures.docs(spark, rows), 5, 80, 1)[2]
    n_pairs = index.groupBy("token").count().selectExpr("sum(count * (count - 1) / 2)").first()[0] or 0
    assert n_pairs <= 4 * index.count()


@pytest.mark.parametrize("room", [0, 1 << 20])
def test_groups_by_learned_shingles(spark, monkeypatch, room):
    monkeypatch.setattr(jaccard_join, "MOST_LEARNED", room)
    rows = passages(2)
    rows += [(1000 + i, f"{t} more", "en") for i, t, _ in rows[::3]] + [(2000, None, None), (None, rows[1][1], "en"), (0, rows[5][1], "en")]
    got = jaccard_join.groups(fixtures.docs(spark, rows), 5, 80, 1)
    assert fixtures.rows_of(got, "doc_id", "n_shingles", "component_id") == plain_groups(rows, 5, 80)


def test_frequent_shingles_need_no_learning(spark, monkeypatch):
    """A passage of a few dozen documents is in the first table, however large the corpus beside it."""
    monkeypatch.setattr(jaccard_join, "_counted", lambda *args: pytest.fail("shingles are counted again"))
    monkeypatch.setattr(jaccard_join, "MOST_FREQUENT", 200)
    passage = " ".join(f"shared{k}" for k in range(25))
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(500 if i >= 60 else 60)) + (" " + passage if i < 60 else ""), "en") for i in range(120)]
    found = jaccard_join.groups(fixtures.docs(spark, rows), 5, 80, jaccard_join.MOST_FREQUENT)
    assert fixtures.rows_of(found, "doc_id", "n_shingles", "component_id") == plain_groups(rows, 5, 80)


def test_python_gets_few_rows_at_once(spark):
    """Tables are written from small batches, and the session's setting is as before afterwards."""
    before = spark.conf.get(tables.BATCH)
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches)
    found = tables.stored(spark.range(0, 9000, 1, 1).mapInArrow(sizes, "n long"), "batches")
    assert sorted(r[0] for r in found.collect())[-1] == tables.BATCH_ROWS
    assert spark.conf.get(tables.BATCH) == before


def test_python_gets_fewer_rows_with_sets(spark):
    before = spark.conf.get(tables.BATCH)
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches)
    with tables.small_batches(spark, 100):
        found = tables.stored(spark.range(0, 9000, 1, 1).mapInArrow(sizes, "n long"), "batches")
    assert sorted(r[0] for r in found.collect())[-1] == 100
    assert spark.conf.get(tables.BATCH) == before
