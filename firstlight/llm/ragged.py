"""Batches of texts as flat numpy arrays: UTF-8 bytes, words, 64-bit hashes.

Everything here works on one bounded chunk of rows inside a Spark task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

# ASCII-only lower case, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# White space that separates words: 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_X = 0x9E3779B97F4A7C15 | 1
_TABLES: dict[str, np.ndarray] = {}
# Bytes enter the hash through this table, so that small values do not look alike.
_BYTE = None


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 bytes of the text with A-Z lower-cased; null counts as empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = h.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """x^i and x^-i modulo 2^64 for i below n."""
    if len(_TABLES.get("up", ())) < n:
        size = max(n, CHUNK_BYTES)
        for name, base in (("up", _X), ("down", pow(_X, -1, 1 << 64))):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            _TABLES[name] = np.multiply.accumulate(t)
    return _TABLES["up"], _TABLES["down"]


def _byte_table() -> np.ndarray:
    global _BYTE
    if _BYTE is None:
        _BYTE = mix(np.arange(1, 257, dtype=np.uint64))
    return _BYTE


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; equal bytes have equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    return hashes_of(span_totals(data), starts, ends)


def span_totals(data: np.ndarray) -> np.ndarray:
    """What ``hashes_of`` takes: running sums over the bytes."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_byte_table()[data] * _powers(len(data) + 1)[0][: len(data)], out=total[1:])
    return total


def hashes_of(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``span_hashes`` of spans of the bytes that the running sums are of."""
    down = _powers(len(total))[1]
    lengths = (ends - starts).astype(np.uint64)
    return mix((total[ends] - total[starts]) * down[starts] + lengths * np.uint64(0xD1B54A32D192ED03))


_POINTS = None


def point_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As ``span_hashes``, over code points."""
    global _POINTS
    if _POINTS is None:
        _POINTS = mix(np.arange(1, 0x110001, dtype=np.uint64))
    up, down = _powers(len(points) + 1)
    total = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(_POINTS[points] * up[: len(points)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins; the last offset is the length."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` bytes of text and at most ``rows`` rows; one longer text is a slice of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total, begin = 0, 0
    for i, n in enumerate(lengths):
        if i > begin and (total + n > limit or i - begin >= rows):
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += int(n)
    if begin < batch.num_rows:
        yield batch.slice(begin)


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and how many words stand before each text."""
    inside = ~space[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between consecutive bounds; empty stretches give 0."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each text's kept words with one space between them, and where each text begins.

    A word that is not its text's first has white space before it, which
    becomes the one space.
    """
    kept = np.flatnonzero(keep)
    change = np.zeros(len(data) + 1, dtype=np.int8)
    change[starts[kept]] += 1
    change[ends[kept]] -= 1
    take = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    text_of = np.searchsorted(bounds, kept, side="right")
    later = kept[1:][text_of[1:] == text_of[:-1]]
    take[starts[later] - 1] = True
    out = data.copy()
    out[starts[later] - 1] = 0x20
    first = np.zeros(len(bounds), dtype=np.int64)
    lengths = np.bincount(text_of - 1, weights=(ends - starts)[kept], minlength=len(bounds) - 1).astype(np.int64)
    words_of = np.bincount(text_of - 1, minlength=len(bounds) - 1)
    np.cumsum(lengths + np.maximum(words_of - 1, 0), out=first[1:])
    return out[take], first


def texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The byte stretches between the offsets as an Arrow column of texts."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
