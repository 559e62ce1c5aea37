"""Exact deduplication of an incoming batch against an immutable snapshot.

Texts are equal when identical after lower-casing A-Z. The snapshot's
distinct digests are dealt into buckets of bounded size and a static 3-wise
binary fuse filter is built for each. Incoming digests, grouped among
themselves first, are screened by their bucket's filter; only positives are
joined with the snapshot's exact buckets, and all copies found are compared
byte by byte. Filters have no false negatives, so a negative digest is new.

Null texts count as empty. Rows with a null ``doc_id`` take part like any
other; an id may repeat. Columns other than ``doc_id`` and ``text`` are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstlight.llm.decontam import lowered
from firstlight.llm.ragged import lower_ascii, mix
from firstlight.llm.tables import discard, free_name, screened, shuffle_partitions, stored

BUCKET_KEYS = 1 << 18
FINGERPRINT_BITS = 16


class FuseFilter:
    """Static 3-wise binary fuse filter over distinct 64-bit keys, with 16-bit fingerprints."""

    def __init__(self, seed: int, segment: int, cells: np.ndarray):
        self.seed, self.segment, self.cells = seed, segment, cells

    @staticmethod
    def _slots(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
        first = (h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)
        low = mix(h ^ np.uint64(0x5851F42D4C957F2D))
        mask = np.uint64(segment - 1)
        place = np.stack([(low >> np.uint64(20 * k)) & mask for k in range(3)])
        slots = (first + np.arange(3, dtype=np.uint64)[:, None]) * np.uint64(segment) + place
        return slots.astype(np.int64), (h & np.uint64((1 << FINGERPRINT_BITS) - 1)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Peels layer by layer: all slots that hold one key are taken at once."""
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << max(2, min(18, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        size = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))) + 8
        segments = max(1, -(-size // segment) - 2)
        for seed in range(1, 1000):
            slots, prints = cls._slots(keys, seed, segment, segments)
            length = (segments + 2) * segment
            degree = np.bincount(slots.ravel(), minlength=length)
            ids = np.arange(n, dtype=np.int64)
            xor = np.zeros(length, dtype=np.int64)
            for k in range(3):
                np.bitwise_xor.at(xor, slots[k], ids)
            layers, left = [], n
            while left:
                single = np.flatnonzero(degree == 1)
                if not len(single):
                    break
                taken, at = np.unique(xor[single], return_index=True)
                layers.append((taken, single[at]))
                left -= len(taken)
                for k in range(3):
                    np.subtract.at(degree, slots[k][taken], 1)
                    np.bitwise_xor.at(xor, slots[k][taken], taken)
            if left == 0:
                cells = np.zeros(length, dtype=np.uint16)
                for taken, own in reversed(layers):
                    value = prints[taken].copy()
                    for k in range(3):
                        s = slots[k][taken]
                        value ^= np.where(s == own, np.uint16(0), cells[s])
                    cells[own] = value
                return cls(seed, segment, cells)
            segments += max(1, segments // 16)
        raise ValueError("no seed peels the keys")

    def contains(self, keys: np.ndarray) -> np.ndarray:
        segments = len(self.cells) // self.segment - 2
        slots, prints = self._slots(keys.astype(np.uint64), self.seed, self.segment, segments)
        return (self.cells[slots[0]] ^ self.cells[slots[1]] ^ self.cells[slots[2]]) == prints

    def to_bytes(self) -> bytes:
        return np.array([self.seed, self.segment], dtype="<u4").tobytes() + self.cells.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> FuseFilter:
        seed, segment = np.frombuffer(raw[:8], dtype="<u4")
        return cls(int(seed), int(segment), np.frombuffer(raw[8:], dtype="<u2"))


def with_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, digest``: SHA-256 of the normalised text."""

    def run(batches):
        for b in batches:
            digests = [hashlib.sha256(lower_ascii(t)).digest() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(digests, pa.binary())], ["doc_id", "digest"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, digest binary")


def _groups(digests: DataFrame) -> DataFrame:
    return digests.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"))


def _key(digest: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(x[:8] for x in digest), dtype=">u8").astype(np.uint64)


def _bucket(buckets: int):
    return (F.conv(F.hex(F.substring("digest", 9, 6)), 16, 10).cast("long") % buckets).alias("bucket")


def build_filters(snapshot_groups: DataFrame, buckets: int) -> DataFrame:
    """``bucket, filter``: one filter for each bucket of the snapshot's distinct digests."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "filter": [FuseFilter.build(_key(pdf["digest"])).to_bytes()]})

    keyed = snapshot_groups.select("digest", _bucket(buckets))
    return keyed.groupBy("bucket").applyInPandas(build, "bucket long, filter binary")


def screen(incoming_groups: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Incoming groups with ``positive``: whether the snapshot may hold the digest."""

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        hit = FuseFilter.from_bytes(right["filter"].iloc[0]).contains(_key(left["digest"])) if len(right) and len(left) else False
        return left[["digest", "n", "keep_id"]].assign(positive=hit)

    keyed = incoming_groups.select("digest", "n", "keep_id", _bucket(buckets))
    return (
        keyed.groupBy("bucket").cogroup(filters.groupBy("bucket"))
        .applyInPandas(probe, "digest binary, n long, keep_id long, positive boolean")
    )


def _checked(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``digest, same``: whether all texts of the digests in ``members`` are the same bytes.

    Copies met in one task are one row before the shuffle, however many there
    are. Texts of ids that are not in ``members`` stay out of it; the few that
    a filter of the ids lets through have digests of their own.
    """

    def lowered(batches):
        for b in batches:
            texts = [lower_ascii(t) for t in b.column("text").to_pylist()]
            digests = [hashlib.sha256(t).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(texts, pa.binary())], ["digest", "bytes"])

    texts = screened(docs, [F.col("doc_id").cast("long")], members.select("doc_id"))[1].select("text")
    exact = texts.mapInArrow(lowered, "digest binary, bytes binary").groupBy("digest", "bytes").agg(F.lit(1).alias("one"))
    return exact.groupBy("digest").agg((F.count("*") == 1).alias("same"))


def dedup_batch(snapshot: DataFrame, incoming: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per document of both inputs: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep_id`` is the largest ``doc_id`` of the group. A digest whose texts
    differ in bytes stops the job; it is never merged.
    """
    return _dedup_batch(snapshot, incoming, bucket_keys)[0]


def _dedup_batch(snapshot: DataFrame, incoming: DataFrame, bucket_keys: int) -> tuple[DataFrame, list[DataFrame]]:
    """``dedup_batch``, and the stored tables that it reads."""
    spark = incoming.sparkSession
    old, new = stored(with_digests(snapshot), "dedup-old"), stored(with_digests(incoming), "dedup-new")
    old_groups, new_groups = stored(_groups(old), "dedup-old-groups"), _groups(new)
    buckets = max(shuffle_partitions(spark), -(-max(old_groups.count(), new.count()) // bucket_keys))
    screened_groups = stored(screen(new_groups, build_filters(old_groups, buckets), buckets), "dedup-screened")
    was = old_groups.select("digest", F.col("n").alias("old_n"), F.col("keep_id").alias("old_keep"))
    met = screened_groups.filter("positive").join(was, "digest", "left")
    fresh = screened_groups.filter("not positive").withColumns({"old_n": F.lit(None).cast("long"), "old_keep": F.lit(None).cast("long")})
    merged_new = met.unionByName(fresh).select(
        "digest",
        (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("group_size"),
        F.greatest("keep_id", "old_keep").alias("keep_id"),
    )
    only_old = old_groups.join(met.filter("old_n is not null").select("digest"), "digest", "left_anti")
    groups = stored(
        merged_new.unionByName(only_old.select("digest", F.col("n").alias("group_size"), "keep_id")), "dedup-groups"
    )
    discard(old_groups, screened_groups)
    rows = old.unionByName(new)
    several = groups.filter("group_size > 1").select("digest")
    same = _checked(snapshot.select("doc_id", "text").unionByName(incoming.select("doc_id", "text")), rows.join(several, "digest", "left_semi"))
    checked = groups.join(same, "digest", "left")
    safe = F.when(F.col("same") == F.lit(False), F.raise_error(F.lit("texts with one digest differ"))).otherwise(F.col("keep_id"))
    joined = rows.join(checked.select("digest", "group_size", safe.cast("long").alias("keep_id")), "digest")
    found = joined.select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    return found, [old, new, groups]


def dedup(docs: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """``dedup_batch`` of a table with itself: the older half of the ids is the snapshot, the newer half the batch."""
    return _dedup(docs, bucket_keys)[0]


def _dedup(docs: DataFrame, bucket_keys: int) -> tuple[DataFrame, list[DataFrame]]:
    middle = docs.agg(((F.min("doc_id") + F.max("doc_id")) / 2).cast("long")).first()[0]
    old = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(True))
    return _dedup_batch(docs.filter(old), docs.filter(~old), bucket_keys)


def without_copies(docs: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows of one id and equal text one stays.

    Only rows that may have the id of a copy are shuffled.
    """
    gone_id, gone_sha, own_sha = (free_name(docs, n) for n in ("gone_id", "gone_sha", "own_sha"))
    found, read = _dedup(docs, bucket_keys)
    copies = stored(found.filter("group_size > 1").select("doc_id", "kept", "text_sha256").distinct(), "dedup-copies")
    discard(*read)
    doc_id = F.col("doc_id").cast("long")
    alone, several = screened(docs, [doc_id], copies.select("doc_id"))
    gone = copies.filter("not kept").select(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_sha))
    text = F.coalesce(F.col("text"), F.lit(""))
    own = several.withColumn(own_sha, F.sha2(lowered(text).cast("binary"), 256))
    kept = own.join(gone, doc_id.eqNullSafe(F.col(gone_id)) & (F.col(own_sha) == F.col(gone_sha)), "left_anti")
    return alone.unionByName(kept.dropDuplicates(["doc_id", own_sha]).drop(own_sha))
