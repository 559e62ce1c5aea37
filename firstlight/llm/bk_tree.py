"""SimHash near-duplicates by BK-trees.

A document's fingerprint has a bit set where more than half of the XXH64
hashes (seed 42) of its word shingles, repeats included, have it set. Two
fingerprints link when they differ in ``radius`` bits or fewer, and
``component_id`` is the smallest ``doc_id`` reachable by links.

Copies are one fingerprint, so only distinct fingerprints are searched. They
are dealt into shards: the 64 bits are cut into radius + 1 blocks, and two
fingerprints that link agree in one block at least, so every link lies within
a shard of those with one value of one block. A shard that is larger than
``SHARD`` is dealt again by the blocks of its remaining bits, by the same
argument without loss; that halves the bits left and more each time, so after
``DEPTH`` rounds a shard has 2^13 fingerprints at most whatever the corpus.

Each shard is one BK-tree: a fingerprint hangs below its parent by the integer
distance between them, one child for each distance. A search for all within
the radius of x visits a node at distance d and then follows only the edges
from d - radius to d + radius. Trees are built and searched level by level in
arrays, for many shards at once. A tree goes to the task that searches it with
the shuffle that deals the shards, not by a broadcast: a shard is bounded, but
the trees of all shards grow with the corpus.

A task passes on one link per fingerprint that has any, to the least one that
it reaches in its shard, so links do not grow with the square of a group.

A null text or one without words has fingerprint zero and is linked like any
other; a text of fewer words than a shingle is one shingle. Rows are kept one
by one, repeated ones too; a null ``doc_id`` never names a group unless all
its ids are null. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstlight.llm.components import components
from firstlight.llm.ragged import LOWER, chunks, joined, utf8, words
from firstlight.llm.tables import stored

SEED = 42
BITS = 64
SHARD = 4096
DEPTH = 4
# Shingles whose bits are unpacked at once, and pairs of a query and a node looked at together.
BLOCK = 1 << 17
VISITS = 1 << 20
# A fingerprint with more than one in HOT of all rows is joined by broadcast: there are fewer than HOT of them.
HOT = 1024


def fingerprints_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The 64-bit fingerprint of each row's text."""
    data, offsets = utf8(batch.column("text"))
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets)
    spaced, firsts = joined(data, starts, ends, bounds, np.ones(len(starts), dtype=bool))
    starts, ends, _ = words(spaced, firsts)
    counts = np.diff(bounds)
    shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds_of = np.concatenate([[0], np.cumsum(shingles)])
    first = np.arange(bounds_of[-1]) + np.repeat(bounds[:-1] - bounds_of[:-1], shingles)
    last = np.minimum(first + width, np.repeat(bounds[1:], shingles)) - 1
    raw, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[last].tolist())), dtype=np.uint64, count=len(first))
    ones = np.zeros((len(counts), BITS), dtype=np.int64)
    of = np.repeat(np.arange(len(counts)), shingles)
    for a in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[a : a + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        texts, at = np.unique(of[a : a + BLOCK], return_index=True)
        ones[texts] += np.add.reduceat(bits, at, axis=0, dtype=np.int64)
    set_ = (2 * ones > shingles[:, None]).astype(np.uint8)
    return np.packbits(set_, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, width: int = 5) -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` holds the 64 bits as a signed number."""

    def run(batches):
        for batch in batches:
            for b in chunks(batch):
                made = fingerprints_of(b, width).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(made)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


class Forest:
    """BK-trees of many shards: members ``fps``, each shard's in one stretch beginning at ``roots``."""

    def __init__(self, fps: np.ndarray, sizes: np.ndarray):
        """A shard's first member is its root; the others are hung up in their order."""
        self.fps, self.sizes = fps, sizes
        begins = np.cumsum(sizes) - sizes
        self.root_of = np.repeat(begins, sizes)
        parent_edge = np.full(len(fps), -1, dtype=np.int64)
        at = self.root_of.copy()
        left = np.flatnonzero(at != np.arange(len(fps)))
        while len(left):
            key = at[left] * (BITS + 1) + np.bitwise_count(fps[left] ^ fps[at[left]])
            order = np.argsort(key, kind="stable")
            first = np.diff(key[order], prepend=-1) != 0
            child = left[order][first]
            parent_edge[child] = key[order][first]
            at[left[order]] = np.repeat(child, np.diff(np.flatnonzero(np.append(first, True))))
            left = left[at[left] != left]
        hung = np.flatnonzero(parent_edge >= 0)
        order = np.argsort(parent_edge[hung], kind="stable")
        self.children, self.edges = hung[order], parent_edge[hung][order]

    def within(self, radius: int):
        """Yields arrays ``x, y`` of members of one shard that differ in ``radius`` bits or fewer, x before y."""
        begin = 0
        total = np.cumsum(np.repeat(self.sizes, self.sizes))
        while begin < len(self.fps):
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + VISITS, side="right")))
            query = np.arange(begin, end)
            node = self.root_of[begin:end]
            while len(query):
                d = np.bitwise_count(self.fps[query] ^ self.fps[node]).astype(np.int64)
                near = (d <= radius) & (query < node)
                yield query[near], node[near]
                low = np.searchsorted(self.edges, node * (BITS + 1) + np.maximum(d - radius, 0))
                high = np.searchsorted(self.edges, node * (BITS + 1) + np.minimum(d + radius, BITS), side="right")
                n = high - low
                query = np.repeat(query, n)
                node = self.children[np.arange(len(query)) + np.repeat(low - (np.cumsum(n) - n), n)]
            begin = end


def least_reached(forest: Forest, radius: int) -> np.ndarray:
    """For each member the least member that links within its shard lead to."""
    label = np.arange(len(forest.fps))
    links = [(x, y) for x, y in forest.within(radius) if len(x)]
    if not links:
        return label
    x, y = (np.concatenate(side) for side in zip(*links))
    while True:
        least = np.minimum(label[x], label[y])
        before = label.copy()
        for end in (x, y):
            np.minimum.at(label, label[end], least)
            np.minimum.at(label, end, least)
        label = label[label]
        if (label == before).all():
            return label


def blocks(mask: int, parts: int) -> list[int]:
    """Masks that add a part of the bits outside ``mask`` to it; the parts share these bits among them."""
    rest = [i for i in range(BITS) if not mask >> i & 1]
    cuts = [len(rest) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << i for i in rest[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _dealt(rows: DataFrame, masks: dict[int, list[int]], at: Column) -> DataFrame:
    """``fp, mask, value``: each fingerprint once for each block that goes on from its mask ``at``."""
    further = F.create_map(*[F.lit(v) for m, ms in masks.items() for v in (_signed(m), [_signed(x) for x in ms])])
    one = rows.select("fp", F.explode(F.element_at(further, at)).alias("mask"))
    return one.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))


def shards(distinct: DataFrame, radius: int, most: int = SHARD, depth: int = DEPTH) -> DataFrame:
    """``members array<long>``: the fingerprints of each shard that holds two or more."""
    masks = {0: blocks(0, radius + 1)}
    found, rows = None, stored(_dealt(distinct, masks, F.lit(0).cast("long")), "simhash-dealt")
    for level in range(1, depth + 1):
        sizes = stored(rows.groupBy("mask", "value").agg(F.count("*").alias("size")).filter("size > 1"), "simhash-sizes")
        fits = (F.col("size") <= most) if level < depth else F.lit(True)
        some = rows.join(sizes.filter(fits), ["mask", "value"]).groupBy("mask", "value").agg(F.collect_list("fp").alias("members"))
        found = some.select("members") if found is None else found.union(some.select("members"))
        large = sizes.filter(~fits)
        if level == depth or large.isEmpty():
            return found
        masks = {m: blocks(m, radius + 1) for ms in masks.values() for m in ms}
        rows = stored(_dealt(rows.join(large, ["mask", "value"], "left_semi"), masks, F.col("mask")), "simhash-dealt")
    return found


def links(distinct: DataFrame, radius: int = 2, most: int = SHARD, depth: int = DEPTH) -> DataFrame:
    """``u, v``: fingerprints joined by links; their components are those of all links."""

    def run(batches):
        for b in batches:
            lists = b.column("members")
            sizes = np.diff(lists.offsets.to_numpy())
            fps = lists.flatten().to_numpy(zero_copy_only=False)
            before = np.concatenate([[0], np.cumsum(sizes)])
            for a, z in _stretches(sizes, most):
                begin, end = before[a], before[z]
                forest = Forest(fps[begin:end].view(np.uint64), sizes[a:z])
                label = least_reached(forest, radius)
                moved = np.flatnonzero(label != np.arange(len(label)))
                own = fps[begin:end]
                yield pa.RecordBatch.from_arrays([pa.array(own[moved]), pa.array(own[label[moved]])], ["u", "v"])

    return shards(distinct, radius, most, depth).mapInArrow(run, "u long, v long").distinct()


def _stretches(sizes: np.ndarray, most: int):
    """Stretches of shards with about ``most`` members each; a larger shard is one alone."""
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += int(n)
    if begin < len(sizes):
        yield begin, len(sizes)


def groups(docs: DataFrame, width: int = 5, radius: int = 2, most: int = SHARD) -> DataFrame:
    """``doc_id, fp, component_id, copies`` of every row; ``copies`` is the number of rows with its fingerprint."""
    made = stored(fingerprints(docs, width), "simhash-fingerprints")
    known = stored(made.groupBy("fp").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least")), "simhash-distinct")
    labels = stored(components(links(known.select("fp"), radius, most)), "simhash-components")
    placed = known.join(labels, known["fp"] == labels["node"], "left").select("fp", "copies", "least", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = stored(placed.join(named, "root").select("fp", "copies", "component_id"), "simhash-named")
    total = made.count()
    hot = of_fp.filter(F.col("copies") * HOT > total)
    common = made.join(F.broadcast(hot), "fp")
    others = made.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(of_fp, "fp")
    return common.unionByName(others).select("doc_id", "fp", "component_id", "copies")


def in_hex(docs: DataFrame, width: int, radius: int) -> DataFrame:
    """``doc_id, fingerprint, component_id, copies``, the fingerprint as 16 lowercase hex digits."""
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return groups(docs, width, radius).select("doc_id", digits, "component_id", "copies")
