"""A Bloom filter of fixed size over the 64-bit keys of a table, built without passing the keys through the driver.

Keys are dealt into buckets; each bucket fills its own segment of the bits in
one task, and only the bits are collected: BITS / 8 bytes at any table size.
With very many keys the filter lets more through, but never loses a key, so it
may only be used to save work before an exact test.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from firstlight.llm.ragged import mix
from firstlight.llm.tables import small_batches

BITS = 1 << 26
BUCKET_KEYS = 1 << 18
PROBES = 2


class Bloom:
    def __init__(self, buckets: int, segments: np.ndarray):
        self.buckets, self.segments = buckets, segments

    def contains(self, keys: np.ndarray) -> np.ndarray:
        bucket, places = _places(keys, self.buckets)
        base = bucket.astype(np.int64) * _segment(self.buckets)
        out = np.ones(len(keys), dtype=bool)
        for p in places:
            at = base + p
            out &= (self.segments[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


def _segment(buckets: int) -> int:
    return max(8, BITS // buckets // 8 * 8)


def _places(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, list[np.ndarray]]:
    h = mix(keys.view(np.uint64))
    places = [(mix(h + np.uint64(i + 1)) % np.uint64(_segment(buckets))).astype(np.int64) for i in range(PROBES)]
    return (h % np.uint64(buckets)).astype(np.int32), places


def bloom(rows: DataFrame, n_keys: int, least: int = 1) -> Bloom:
    """Filter of the keys in the ``keys array<long>`` column that stand in at least ``least`` places."""
    buckets = max(64, -(-n_keys // BUCKET_KEYS))
    segment = _segment(buckets)

    def deal(batches):
        for b in batches:
            keys = b.column(0).flatten().to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            bucket, _ = _places(keys, buckets)
            order = np.argsort(bucket, kind="stable")
            at = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            parts = np.split(keys[order], at[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[order][at]), pa.array([p.tobytes() for p in parts], pa.binary())], ["bucket", "part"]
            )

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(pdf["part"]), dtype=np.int64)
        if least > 1:
            unique, n = np.unique(keys, return_counts=True)
            keys = unique[n >= least]
        bits = np.zeros(segment, dtype=bool)
        for p in _places(keys, buckets)[1]:
            bits[p] = True
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    dealt = rows.select("keys").mapInArrow(deal, "bucket int, part binary")
    segments = np.zeros(buckets * segment // 8, dtype=np.uint8)
    with small_batches(rows.sparkSession):
        filled = dealt.groupBy("bucket").applyInPandas(fill, "bucket int, bits binary").collect()
    for r in filled:
        segments[r["bucket"] * segment // 8 : (r["bucket"] + 1) * segment // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return Bloom(buckets, segments)
