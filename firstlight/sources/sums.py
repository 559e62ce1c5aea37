"""Sums that batches keep up to date with signed increments.

A batch adds rows of keys and ``n``, positive or negative, as one folder
``changes/batch_id=<b>``; written again, the batch replaces them. A fold
writes the sums of all batches up to a number as ``sums/upto=<b>``. Reading
takes the last committed fold and the changes after it, so a change counts
once whatever a fold that died has left behind.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firstlight.sources import folders
from firstlight.sources.store import no_rows


def write_changes(changes: DataFrame, path: str, batch_id: int, keys: Sequence[str]) -> None:
    """One batch's increments, merged by key; zeros are left out."""
    merged = changes.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0")
    merged.coalesce(1).write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")


def _parts(spark: SparkSession, path: str, upto: int | None = None) -> list[str]:
    folds = [n for n in folders.numbers(spark, f"{path}/sums", "upto") if upto is None or n <= upto]
    done = folds[-1] if folds else None
    later = [n for n in folders.numbers(spark, f"{path}/changes", "batch_id") if (done is None or n > done) and (upto is None or n <= upto)]
    return ([f"{path}/sums/upto={done}"] if folds else []) + [f"{path}/changes/batch_id={n}" for n in later]


def read_sums(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], upto: int | None = None) -> DataFrame:
    """``keys, n`` with n other than 0."""
    parts = _parts(spark, path, upto)
    rows = spark.read.schema(schema).parquet(*parts) if parts else no_rows(spark, schema)
    return rows.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0")


def fold_sums(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], upto: int, grace: float = folders.GRACE) -> None:
    """Fold the batches up to ``upto``; what the fold before replaced goes when that is ``grace`` seconds old."""
    folds = folders.numbers(spark, f"{path}/sums", "upto")
    if folds and folders.age(spark, f"{path}/sums/upto={folds[-1]}/_SUCCESS") >= grace:
        gone = [n for n in folders.numbers(spark, f"{path}/changes", "batch_id", committed=False) if n <= folds[-1]]
        folders.remove(spark, [f"{path}/changes/batch_id={n}" for n in gone])
        folders.remove(spark, [f"{path}/sums/upto={n}" for n in folds[:-1]])
    if len(_parts(spark, path, upto)) > 1:
        sums = read_sums(spark, path, schema, keys, upto)
        sums.coalesce(1).write.mode("overwrite").parquet(f"{path}/sums/upto={upto}")
