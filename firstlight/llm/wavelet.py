"""Token ids in wavelet-matrix files.

A file holds the ids of consecutive documents as bit planes, from the highest
bit to the lowest; at each plane the ids with bit 0 move before those with bit
1. Planes are cut into blocks that are compressed one by one, with the number
of ones before each block stored beside them, so that access, counting and
occurrence lookup read only the blocks they touch.

Layout, little-endian: magic, JSON header length, JSON header, then the
compressed parts that the header names by offset and size.
"""

from __future__ import annotations

import json
import uuid
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firstlight.llm import pretokens
from firstlight.llm.ragged import chunks
from firstlight.llm.tables import filesystem, shuffle_partitions, stored
from firstlight.session import scratch_dir

MAGIC = b"WVMATRX1"
BLOCK_BITS = 1 << 18
FILE_TOKENS = 1 << 21
CHUNK_BYTES = 1 << 20
MEMO_ENTRIES = 1 << 20
JOINED_WORDS = 1 << 12
NO_ID = np.iinfo(np.int64).min
END_ID = 0


def encode_file(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The file of ``ids``, the concatenated documents of ``lengths``; a null doc id is ``NO_ID``."""
    z = zstandard.ZstdCompressor(level=1)
    body, at = [], 0

    def put(raw: bytes) -> list[int]:
        nonlocal at
        packed = z.compress(raw)
        body.append(packed)
        at += len(packed)
        return [at - len(packed), len(packed)]

    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    row = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    planes, below = [], np.empty_like(row)
    for level in range(bits):
        bit = (row & row.dtype.type(1 << (bits - 1 - level))).astype(bool)
        blocks, ones = [], [0]
        for b in range(0, len(row), BLOCK_BITS):
            part = bit[b : b + BLOCK_BITS]
            blocks.append(put(np.packbits(part, bitorder="little").tobytes()))
            ones.append(ones[-1] + int(np.count_nonzero(part)))
        planes.append({"blocks": blocks, "ones": ones})
        # Places, since masks of mixed bits are several times slower; they are all inside the row, so nothing is clipped.
        zeros = len(row) - ones[-1]
        np.take(row, np.flatnonzero(~bit), out=below[:zeros], mode="clip")
        np.take(row, np.flatnonzero(bit), out=below[zeros:], mode="clip")
        row, below = below, row
    head = {
        "n": len(ids), "docs": len(doc_ids), "bits": bits, "block_bits": BLOCK_BITS, "planes": planes,
        "doc_ids": put(doc_ids.astype("<i8").tobytes()), "lengths": put(lengths.astype("<i8").tobytes()),
    }
    raw = json.dumps(head, separators=(",", ":")).encode()
    return MAGIC + len(raw).to_bytes(8, "little") + raw + b"".join(body)


class WaveletMatrix:
    """Reads one file: ``access``, ``count`` and ``occurrences`` touch only the blocks they need."""

    def __init__(self, file):
        if file.read(8) != MAGIC:
            raise ValueError("not a wavelet-matrix file")
        size = int.from_bytes(file.read(8), "little")
        self.head = json.loads(file.read(size))
        self._file, self._base = file, 16 + size
        self.n, self.bits, self.block = self.head["n"], self.head["bits"], self.head["block_bits"]
        self._block = lru_cache(maxsize=64)(self._read_block)

    def _raw(self, place: list[int]) -> bytes:
        self._file.seek(self._base + place[0])
        return zstandard.ZstdDecompressor().decompress(self._file.read(place[1]))

    def _read_block(self, level: int, b: int) -> np.ndarray:
        size = min(self.block, self.n - b * self.block)
        raw = np.frombuffer(self._raw(self.head["planes"][level]["blocks"][b]), dtype=np.uint8)
        return np.unpackbits(raw, count=size, bitorder="little").view(bool)

    def _zeros(self, level: int) -> int:
        return self.n - self.head["planes"][level]["ones"][-1]

    def _rank1(self, level: int, i: int) -> int:
        """Ones before position i."""
        b, rest = divmod(i, self.block)
        before = self.head["planes"][level]["ones"][b]
        return before + (int(np.count_nonzero(self._block(level, b)[:rest])) if rest else 0)

    def _select(self, level: int, one: bool, k: int) -> int:
        """Where the k-th (from 0) one or zero stands."""
        ones = np.array(self.head["planes"][level]["ones"])
        before = ones if one else np.minimum(np.arange(len(ones)) * self.block, self.n) - ones
        b = int(np.searchsorted(before, k, side="right")) - 1
        return b * self.block + int(np.flatnonzero(self._block(level, b) == one)[k - before[b]])

    def access(self, i: int) -> int:
        """The id at position i."""
        value = 0
        for level in range(self.bits):
            b, rest = divmod(i, self.block)
            one = bool(self._block(level, b)[rest])
            rank = self._rank1(level, i)
            i = self._zeros(level) + rank if one else i - rank
            value = value << 1 | one
        return value

    def _range(self, symbol: int, begin: int, end: int) -> tuple[int, int]:
        for level in range(self.bits):
            a, b = self._rank1(level, begin), self._rank1(level, end)
            if symbol >> (self.bits - 1 - level) & 1:
                begin, end = self._zeros(level) + a, self._zeros(level) + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def count(self, symbol: int, begin: int = 0, end: int | None = None) -> int:
        """How often the id stands in [begin, end)."""
        if symbol >> self.bits:
            return 0
        begin, end = self._range(symbol, begin, self.n if end is None else end)
        return end - begin

    def occurrence(self, symbol: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of the id."""
        if not 0 <= k < self.count(symbol):
            raise IndexError(k)
        i = self._range(symbol, 0, self.n)[0] + k
        for level in reversed(range(self.bits)):
            one = bool(symbol >> (self.bits - 1 - level) & 1)
            i = self._select(level, one, i - self._zeros(level) if one else i)
        return i

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """Doc ids and lengths."""
        return np.frombuffer(self._raw(self.head["doc_ids"]), "<i8"), np.frombuffer(self._raw(self.head["lengths"]), "<i8")

    def all_ids(self) -> np.ndarray:
        """All ids in order, rebuilt from the lowest plane up."""
        row = np.zeros(self.n, dtype=np.uint16 if self.bits <= 16 else np.uint32)
        for level in reversed(range(self.bits)):
            blocks = [self._read_block(level, b) for b in range(len(self.head["planes"][level]["blocks"]))]
            bit = np.concatenate(blocks) if blocks else np.zeros(0, dtype=bool)
            zeros = self._zeros(level)
            above = np.empty_like(row)
            above[np.flatnonzero(~bit)] = row[:zeros]
            above[np.flatnonzero(bit)] = row[zeros:] | row.dtype.type(1 << (self.bits - 1 - level))
            row = above
        return row


class Encoder:
    """Ids of texts by the tokenizers library; a pre-token is given to it once while it is remembered, by its hash.

    What is remembered never changes a result, so a process keeps its encoder from task to task.
    """

    def __init__(self, path: str):
        self.tokenizer, self.splitter = pretokens.load(path)
        self.special = pretokens.special_strings(path)
        self.joiner, self.bytes_of = pretokens.at_blanks(path), pretokens.token_bytes(path)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.entry = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)
        self.starts = np.zeros(1, dtype=np.int64)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key; -1 for a new one."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        order = np.argsort(keys)
        at = np.minimum(np.searchsorted(self.keys, keys[order]), len(self.keys) - 1)
        out = np.empty(len(keys), dtype=np.int64)
        out[order] = np.where(self.keys[at] == keys[order], self.entry[at], -1)
        return out

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(sizes.sum())), sizes

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_one_by_one`` for words with their only blank in front, many in one text; byte counts tell where each ends."""
        rows = ["".join(words[i : i + JOINED_WORDS]) for i in range(0, len(words), JOINED_WORDS)]
        if any(name in row for row in rows for name in self.special):
            return self._one_by_one(words)
        found = [e.ids for e in self.joiner.encode_batch_fast(rows, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=sum(map(len, found)))
        until = np.cumsum(self.bytes_of[ids])
        ends = np.cumsum([len(w.encode()) for w in words])
        last = np.searchsorted(until, ends)
        if not len(ids) or until[-1] != ends[-1] or (until[last] != ends).any():
            return self._one_by_one(words)
        return ids, np.diff(last + 1, prepend=0)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        led = np.array([w.rfind(" ") == 0 for w in words], dtype=bool)
        for which, encode in ((led, self._joined), (~led, self._one_by_one)):
            at = np.flatnonzero(which)
            if len(at):
                ids, sizes = encode([words[i] for i in at.tolist()])
                entries = np.arange(len(at)) + len(self.starts) - 1
                self.ids = np.concatenate([self.ids, ids])
                self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
                all_keys = np.concatenate([self.keys, keys[at]])
                order = np.argsort(all_keys, kind="stable")
                self.keys, self.entry = all_keys[order], np.concatenate([self.entry, entries])[order]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and the number of ids of each text."""
        parts, owner, after = pretokens.pieces(texts, self.special)
        found = self.splitter.spans(parts)
        if len(self.keys) > MEMO_ENTRIES:
            self._clear()
        known = self._places(found.keys)
        new = np.flatnonzero(known < 0)
        if len(new):
            self._learn(found.keys[new], found.strings(new))
            known[new] = self._places(found.keys[new])
        entry, bounds = known[found.codes], found.bounds
        # A special string is one more token behind the part before it.
        begin, size = self.starts[entry], self.starts[entry + 1] - self.starts[entry]
        out_at = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(size, out=out_at[1:])
        ids = self.ids[np.repeat(begin - out_at[:-1], size) + np.arange(out_at[-1])]
        part_ends = out_at[bounds[1:]]
        per_part = part_ends - out_at[bounds[:-1]]
        marks = np.array(after)
        if (marks >= 0).any():
            ids = np.insert(ids, part_ends[marks >= 0], marks[marks >= 0])
            per_part = per_part + (marks >= 0)
        return ids, np.bincount(owner, weights=per_part, minlength=len(texts)).astype(np.int64)


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    return Encoder(path)


def write_ids(docs: DataFrame, tokenizer: str, folder: str, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes the ids of all documents in ascending ``doc_id`` order; returns the committed manifest.

    Null ids come first, rows of one id are ordered by their text; a null text
    is empty. Only files named in the manifest count.
    """

    def run(batches):
        encoder, part = encoder_of(tokenizer), TaskContext.get().partitionId()
        held, doc_ids, lengths, total, number = [], [], [], 0, 0

        def done():
            path = f"{folder}/part-{part:06d}-{number:06d}-{uuid.uuid4().hex}.wvm"
            fs, inner = filesystem(path)
            fs.create_dir(inner.rpartition("/")[0], recursive=True)
            raw = encode_file(np.concatenate(held), np.array(doc_ids, dtype=np.int64), np.array(lengths, dtype=np.int64))
            with fs.open_output_stream(inner, compression=None) as out:
                out.write(raw)
            row = {"path": path, "part": part, "number": number, "docs": len(doc_ids), "tokens": total, "bytes": len(raw)}
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for b in chunks(batch, limit=CHUNK_BYTES):
                ids, n = encoder([t or "" for t in b.column("text").to_pylist()])
                ids = np.insert(ids, np.cumsum(n), END_ID)
                held.append(ids.astype(np.uint32))
                doc_ids += [NO_ID if i is None else i for i in b.column("doc_id").to_pylist()]
                lengths += (n + 1).tolist()
                total += len(ids)
                if total >= file_tokens:
                    yield done()
                    held, doc_ids, lengths, total, number = [], [], [], 0, number + 1
        if doc_ids:
            yield done()

    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(
        rows.mapInArrow(run, "path string, part long, number long, docs long, tokens long, bytes long"), "wavelet-manifest"
    )


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``first``: ids in all files before; summed per range first, then within each range."""
    totals = manifest.groupBy("part").agg(F.sum("tokens").alias("sum"))
    before = F.sum("sum").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = totals.select(F.col("part").alias("of"), F.coalesce(before, F.lit(0)).alias("base"))
    inside = F.sum("tokens").over(Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    return (
        manifest.withColumn("inside", F.coalesce(inside, F.lit(0)))
        .join(parts, F.col("part") == F.col("of")).select("path", (F.col("base") + F.col("inside")).alias("first"))
    )


def read_ids(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    files = with_starts(manifest).repartition(shuffle_partitions(manifest.sparkSession))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fs, inner = filesystem(r["path"])
                with fs.open_input_file(inner) as file:
                    matrix = WaveletMatrix(file)
                    ids = matrix.all_ids().astype("<u4")
                    doc_ids, lengths = matrix.documents()
                ends = np.cumsum(lengths)
                view = memoryview(ids)
                sums = [zlib.crc32(view[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, mask=doc_ids == NO_ID), pa.array(r["first"] + ends - lengths),
                        pa.array(lengths.copy()), pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes the documents' ids and reads the files back."""
    return read_ids(write_ids(docs, tokenizer, scratch_dir(docs.sparkSession, "wavelet"), file_tokens))
