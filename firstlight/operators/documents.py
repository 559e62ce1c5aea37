"""Keyed documents: upsert by explicit id, last write wins.

A write adds its documents as one folder ``version=<n>/tier=0``; reading takes
the newest version of each id.  So that reads do not go through ever more
folders, runs of neighbouring folders of about the same size are merged into
one, and those again: a document is rewritten once for each size class, and
the number of folders grows with the logarithm of the table.  A merged folder
carries the largest version that it holds, which keeps the order right; what
it replaced stays for readers that hold it (:mod:`firstlight.sources.folders`).
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from firstlight.operators.dedup import latest_by_key
from firstlight.sources import folders
from firstlight.sources.store import no_rows

# Folders of a size class that are merged, and the bytes of the smallest class.
FANOUT = 4
SMALL = 32 << 20

_VERSION = ["version", "tier"]


def documents_from_json(spark: SparkSession, bodies: Sequence[str], schema: StructType) -> DataFrame:
    """Typed documents from the JSON bodies a caller hands in (single upserts)."""
    text = spark.createDataFrame([(b,) for b in bodies], "body string")
    return text.select(F.from_json("body", schema, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def upsert_documents(docs: DataFrame, path: str, version: int) -> None:
    """Write one version; a retry with the same number replaces it.  Ids are unique within a version."""
    docs.write.mode("overwrite").parquet(f"{path}/version={version}/tier=0")


def _folders(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """``(version, tier)`` of all committed folders, in order of version."""
    versions = folders.numbers(spark, path, "version", committed=False)
    return [(v, t) for v in versions for t in folders.numbers(spark, f"{path}/version={v}", "tier")]


def _name(version: int, tier: int) -> str:
    return f"version={version}/tier={tier}"


def _held(spark: SparkSession, path: str) -> dict[tuple[int, int], float]:
    """Folders that a merge replaced, and for how many seconds; a merge holds all of smaller versions down to its first."""
    found: dict[tuple[int, int], float] = {}
    for v, t in _folders(spark, path):
        for name, since in folders.held_by(spark, f"{path}/{_name(v, t)}"):
            version, tier = (int(part.split("=")[1]) for part in name.split("/"))
            found[(version, tier)] = max(since, found.get((version, tier), 0.0))
    return found


def live_folders(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The folders that make up the table now, in order of version."""
    replaced = _held(spark, path)
    return [f for f in _folders(spark, path) if f not in replaced]


def read_documents(spark: SparkSession, path: str, schema: StructType, key: str = "id") -> DataFrame:
    """The newest version of every document."""
    live = live_folders(spark, path)
    full = StructType([*schema.fields, *[StructField(c, LongType()) for c in _VERSION]])
    if not live:
        return no_rows(spark, full).drop(*_VERSION)
    rows = spark.read.schema(full).option("basePath", path).parquet(*[f"{path}/{_name(*f)}" for f in live])
    return latest_by_key(rows, [key], _VERSION).drop(*_VERSION)


def _size_class(size: int, small: int, fanout: int) -> int:
    return max(0, math.ceil(math.log(max(size, 1) / small, fanout)))


def merge_documents(
    spark: SparkSession,
    path: str,
    schema: StructType,
    key: str = "id",
    fanout: int = FANOUT,
    small: int = SMALL,
    grace: float = folders.GRACE,
) -> int:
    """Merge until no ``fanout`` neighbouring folders are of one size class or smaller; the number of merges.

    First the folders replaced ``grace`` seconds ago are removed.  A merge that
    died leaves no commit mark and is made again under the same name.
    """
    folders.remove(spark, [f"{path}/{_name(*f)}" for f, since in _held(spark, path).items() if since >= grace])
    merges = 0
    while True:
        live = live_folders(spark, path)
        classes = [_size_class(folders.size(spark, f"{path}/{_name(*f)}"), small, fanout) for f in live]
        run = _mergeable(classes, fanout)
        if not run:
            return merges
        chosen = live[run[0] : run[1]]
        full = StructType([*schema.fields, *[StructField(c, LongType()) for c in _VERSION]])
        rows = spark.read.schema(full).option("basePath", path).parquet(*[f"{path}/{_name(*f)}" for f in chosen])
        version = chosen[-1][0]
        tier = 1 + max(t for v, t in _folders(spark, path) if v == version)
        newest = latest_by_key(rows, [key], _VERSION).drop(*_VERSION)
        newest.hint("rebalance").write.mode("overwrite").parquet(f"{path}/{_name(version, tier)}")
        folders.note_held(spark, path, _name(version, tier), [_name(*f) for f in chosen])
        merges += 1


def _mergeable(classes: list[int], fanout: int) -> tuple[int, int] | None:
    """The newest run of ``fanout`` or more folders in which none is of a larger class than the oldest of them."""
    end = len(classes)
    while end > 0:
        begin = end - 1
        while begin > 0 and classes[begin - 1] <= classes[end - 1]:
            begin -= 1
        if end - begin >= fanout:
            return begin, end
        end = begin if begin < end - 1 else end - 1
    return None
