import pytest
from helpers import ms, records, rows
from pyspark.sql import functions as F

from firstlight.operators import dedup

MORNING, NOON, NEXT = ms("2024-01-01 08:00"), ms("2024-01-01 12:00"), ms("2024-01-02 01:00")


def test_first_per_day(spark):
    df = records(spark, [("a", NOON, "x"), ("a", MORNING, "y"), ("a", NEXT, "z"), ("b", NOON, "x"), ("b", NOON, "w")])
    assert rows(dedup.first_per_day(df), "dt", "mid", "hr", "ch") == [
        ("2024-01-01", "a", "08", "y"),
        ("2024-01-01", "b", "12", "w"),
        ("2024-01-02", "a", "01", "z"),
    ]


def test_ties_do_not_depend_on_row_order(spark):
    ties = [("a", NOON, c) for c in ("q", None, "b", "z")]
    for order in (ties, ties[::-1]):
        assert rows(dedup.first_per_day(records(spark, order)), "mid", "ch") == [("a", None)]


def test_latest_by_key(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), ("b", 1, "only")], "k string, v int, x string")
    assert rows(dedup.latest_by_key(df, ["k"], ["v", "x"])) == [("a", 3, "new"), ("b", 1, "only")]


def test_new_and_earlier(spark):
    seen = records(spark, [("a", NOON, "x"), ("b", NOON, "x")])
    batch = records(spark, [("a", MORNING, "y"), ("b", NOON, "x"), ("c", NOON, "y"), ("a", NEXT, "y")])
    assert rows(dedup.new_to_day(batch, seen), "dt", "mid") == [("2024-01-01", "c"), ("2024-01-02", "a")]
    assert rows(dedup.earlier_than_seen(batch, seen), "dt", "mid", "hr") == [
        ("2024-01-01", "a", "08"),
        ("2024-01-01", "c", "12"),
        ("2024-01-02", "a", "01"),
    ]


def test_earlier_with_null_fields(spark):
    """A NULL tie field counts as smallest, on either side."""
    seen = records(spark, [("a", NOON, "x"), ("b", NOON, None)])
    batch = records(spark, [("a", NOON, None), ("b", NOON, "x")])
    assert rows(dedup.earlier_than_seen(batch, seen), "mid", "ch") == [("a", None)]


@pytest.mark.parametrize("hot", [20_000])
def test_hot_key_is_reduced_before_the_shuffle(spark, hot):
    df = spark.range(hot).select(
        F.lit("2024-01-01").alias("dt"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("mid"),
        F.col("id").alias("ts"),
    )
    first = dedup.first_per_day(df, order=["ts"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("Final")  # printed top down
    assert first.count() == df.select("mid").distinct().count()
    assert first.filter("mid = 'hot'").first()["ts"] == 0
