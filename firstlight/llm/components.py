"""Connected components of an edge table, by alternating star contractions.

Each round is two aggregations and joins over the edges; the number of rounds
grows with the logarithm of the longest chain. Rounds are written to the
shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstlight.llm.tables import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs the larger neighbours of each node below its least neighbour or itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs each node's smaller neighbours and itself below the least of them; edges go from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (u, v)``: root is the least node of the component."""
    now = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "components"
    )
    before, state = None, _state(now)
    while before != state:
        last, now = now, stored(_small_star(_large_star(now)), "components")
        discard(last)
        before, state = state, _state(now)
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
