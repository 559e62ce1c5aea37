"""Folders of a table: listing, commit marks, and removal of what was folded into another folder.

A fold writes the rows of several folders as one more, then notes in a file of
that folder (readers pass over names with an underscore) which ones it holds.
Those are removed by a later fold, ``grace`` seconds after the note: a frame
that listed them before can still be read to its end.
"""

from __future__ import annotations

import time
from typing import Iterable

from pyspark.sql import SparkSession

# Seconds that folded folders stay for readers that hold them.
GRACE = 600.0

_COMMITTED = "_SUCCESS"
_HELD = "_folded"


def _fs(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder; none where it does not exist."""
    fs, path = _fs(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def numbers(spark: SparkSession, folder: str, column: str, committed: bool = True) -> list[int]:
    """The partition numbers ``<column>=<n>`` in a folder, those with a commit mark only unless told otherwise."""
    found = [n for n in names(spark, folder) if n.startswith(f"{column}=")]
    if committed:
        found = [n for n in found if exists(spark, f"{folder}/{n}/{_COMMITTED}")]
    return sorted(int(n.split("=", 1)[1]) for n in found)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def size(spark: SparkSession, folder: str) -> int:
    """Bytes of the folder's files."""
    fs, path = _fs(spark, folder)
    return fs.getContentSummary(path).getLength()


def remove(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        fs, path = _fs(spark, folder)
        fs.delete(path, True)


def age(spark: SparkSession, path: str) -> float:
    """Seconds since the file was written."""
    fs, p = _fs(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, replaced as a whole; for a few lines that need no job."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def note_held(spark: SparkSession, parent: str, fold: str, held: Iterable[str]) -> None:
    """Note that the folder ``fold`` of ``parent`` holds the rows of the folders ``held`` beside it."""
    write_text(spark, f"{parent}/{fold}/{_HELD}", "\n".join(held))


def held_by(spark: SparkSession, fold: str) -> list[tuple[str, float]]:
    """Names of the folders whose rows a fold holds, and for how many seconds; none if it is no fold."""
    note = f"{fold}/{_HELD}"
    if not exists(spark, note):
        return []
    fs, path = _fs(spark, note)
    stream = fs.open(path)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    since = age(spark, note)
    return [(name, since) for name in text.split("\n")]


def held(spark: SparkSession, parent: str) -> dict[str, float]:
    """Folders of ``parent`` that are still there although a fold holds their rows, and for how many seconds it does."""
    found: dict[str, float] = {}
    there = names(spark, parent)
    for fold in there:
        for name, since in held_by(spark, f"{parent}/{fold}"):
            if name in there:
                found[name] = max(found.get(name, 0.0), since)
    return found


def sweep(spark: SparkSession, parent: str, grace: float = GRACE) -> list[str]:
    """Remove folders held by a fold for ``grace`` seconds; the names of those held but still there."""
    since = held(spark, parent)
    remove(spark, [f"{parent}/{n}" for n, s in since.items() if s >= grace])
    return [n for n, s in since.items() if s < grace]
