"""Pages by number out of any depth.

``orderBy().offset(n)`` brings n rows to one place to count them off.  Here
the table is laid out in ranges of the sort order, ``rows/part=<n>``, beside
an index of one row per part.  The rows of each part are counted, running sums
of the counts tell which parts a page lies in, and only these are read and
sorted: page 1,000,000 costs what page 1 does.
"""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Sort = Sequence[tuple[str, str]]

PART = "part"


def sort_columns(sort: Sort) -> list[Column]:
    """NULLs come last either way."""
    return [F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last() for c, way in sort]


def write_ranged(df: DataFrame, path: str, sort: Sort, parts: int) -> None:
    """Write the rows in ``parts`` ranges of ``sort`` and their index, ``part, first, last, n``.

    Part numbers ascend in the sort's order; ``first`` and ``last`` are the
    least and greatest value of its first column in the part.  The ranges come
    from a sample; a bad one makes parts of unequal size, no wrong page.
    """
    order = sort_columns(sort)
    ranged = df.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id())
    within = ranged.sortWithinPartitions(PART, *order)
    within.write.mode("overwrite").partitionBy(PART).parquet(f"{path}/rows")
    # A part without rows keeps the columns of an empty table.
    df.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/rows/{PART}=-1")
    lead = F.col(sort[0][0])
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    index = rows.groupBy(PART).agg(F.min(lead).alias("first"), F.max(lead).alias("last"), F.count("*").alias("n"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def read_ranged(spark: SparkSession, path: str, value: Any = None) -> DataFrame:
    """The rows of a ranged table and their ``part``; with ``value`` those whose first sort column is equal to it.

    The index tells the parts that can hold the value: the other folders are
    left out of the scan, and within these Parquet's own statistics are used.
    """
    rows = spark.read.parquet(f"{path}/rows")
    if value is None:
        return rows
    index = spark.read.parquet(f"{path}/index").filter((F.col("first") <= value) & (F.col("last") >= value))
    held = [r[PART] for r in index.select(PART).collect()]  # the parts of one value
    return rows.filter(F.col(PART).isin(held))


def parts_of_page(counts: DataFrame, page: int, size: int) -> DataFrame:
    """``part, before`` of the parts that hold rows of the page; ``before`` rows come ahead of the part.

    ``counts``: ``part, n``, one row per part.
    """
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    ahead = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(PART, "n", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    first = (page - 1) * size
    return placed.filter((F.col("before") < first + size) & (F.col("before") + F.col("n") > first)).select(PART, "before")


def rows_of_page(rows: DataFrame, before: Column, sort: Sort, page: int, size: int) -> DataFrame:
    """The page out of the rows of its parts, with ``place``, each row's number in the whole order from 1.

    ``before`` is how many rows come ahead of the row's part.
    """
    own = F.row_number().over(Window.partitionBy(PART).orderBy(*sort_columns(sort)))
    first = (page - 1) * size
    return rows.withColumn("place", own + before).filter((F.col("place") > first) & (F.col("place") <= first + size))


def ranged_page(rows: DataFrame, sort: Sort, page: int, size: int) -> DataFrame:
    """Page ``page`` (from 1) of the rows of a ranged table, filtered or not, with their ``place``; unordered.

    The parts of the page reach the scan as a filter at run time, so the
    other parts' folders are not read again after their rows are counted.
    """
    wanted = parts_of_page(rows.groupBy(PART).agg(F.count("*").alias("n")), page, size)
    # One row per part of the page: two or three.
    found = rows.join(F.broadcast(wanted), PART)
    return rows_of_page(found, F.col("before"), sort, page, size).drop(PART, "before")
