"""Language-model scores by context-tree weighting over bytes, with a unigram word baseline.

A text is its UTF-8 bytes with A-Z lower-cased and one end symbol. A byte is
eight binary decisions; each decision, given the bits before it, has a context
tree over the last ``DEPTH`` bytes. Every node has a Krichevsky-Trofimov
estimate of its counts, and a node's weighted probability is the even mixture
of its own estimate and the product of its children's. With the counts of the
training corpus fixed, a byte's probability is the mixture over all depths by
the nodes' weights; contexts never seen add no depth. The probabilities of all
bytes after any context sum to one.

Counts of all (context, byte) pairs and of all words are gathered from the
whole training corpus. Rows are dealt into blocks of about ``BLOCK_BYTES`` by
a hash of the row. A block asks for its distinct pairs once, as sorted keys
with how often its training rows have them; what the blocks ask of one bucket
of contexts lies together. The tree is built in parts, one for each pair of last
bytes; only the nodes above, as many as the alphabet allows, meet in one place.
A bucket answers each block, and the block, which
has the same rows again, adds the answers up for each of its texts.
Tasks that score hold the ``FREQUENT`` most frequent words at most; the others
are scored by a join with the full table and added.

A null text is empty: it has the end only. Repeated rows get equal scores;
other columns are ignored. Without training rows every decision is even.
"""

from __future__ import annotations

import math
import uuid
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstlight.llm.language_id import crc32_of_id
from firstlight.llm.ragged import LOWER, chunks, mix, span_hashes, sums, utf8, words
from firstlight.llm.tables import discard, stored

# With the byte itself, as many as a 64-bit key holds.
DEPTH = 7
# Not a byte of UTF-8: the end of a text, and what stands before its beginning.
END = 0xFF
FREQUENT = 1 << 19
BITS = 8
# Nodes of this depth and deeper are in parts of the tree of their own.
SPLIT = 2
HELD = 1 << 22
BLOCK_BYTES = 24 << 20
# Parts are built together up to about as many pairs.
TOGETHER = 1 << 17
# Log10 of the chance of a byte when every bit is even; answers are given relative to it.
EVEN = -BITS * math.log10(2)
CODEC = "zstd"


def pair_keys(column: pa.Array, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """A key for each byte and end of all texts, and how many keys stand before each text.

    From the highest byte: the last byte before, the one before it, ..., and
    in the lowest byte the byte itself, so sorted keys follow the tree.
    """
    data, offsets = utf8(column)
    n = len(offsets) - 1
    # Each text with its end, and `depth` ends in front; 7 before all, so that eight bytes end at each place.
    row = np.full(7 + len(data) + n * (depth + 1), END, dtype=np.uint8)
    real = np.ones(len(row), dtype=bool)
    real[:7] = False
    starts = 7 + offsets[:-1] + np.arange(n) * (depth + 1)
    for k in range(depth):
        real[starts + k] = False
    own = real.copy()
    own[starts + depth + np.diff(offsets)] = False
    row[own] = LOWER[data]
    # Read as a little-endian number, the last byte of eight is the highest, the one before it the next.
    eight = np.ndarray((len(row) - 7,), dtype="<u8", buffer=row, strides=(1,)).astype(np.uint64)[real[7:]]
    symbol = eight >> np.uint64(56)
    key = eight << np.uint64(8)
    if depth < 7:
        key = key >> np.uint64(8 * (8 - depth)) << np.uint64(8)
    return key | symbol, offsets + np.arange(n + 1)


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of all texts, and how many words stand before each text."""
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets)
    return span_hashes(data, starts, ends), bounds


def _counted(docs: DataFrame, keys_of, name: str) -> DataFrame:
    """``key, n`` over all rows; counted inside each task first."""

    def run(batches):
        held, size = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

        for batch in batches:
            for b in chunks(batch):
                keys = keys_of(b.column("text"))[0]
                held.append(keys)
                size += len(keys)
                if size > HELD:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return stored(docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), name)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Log of the gamma function above zero, by Stirling's series after eight steps up."""
    up = x + 8
    series = 1 / (12 * up) - 1 / (360 * up**3) + 1 / (1260 * up**5)
    value = (up - 0.5) * np.log(up) - up + 0.5 * np.log(2 * np.pi) + series
    for k in range(8):
        value -= np.log(x + k)
    return value


@lru_cache(maxsize=2)
def _log_gammas(above: float) -> np.ndarray:
    return _log_gamma(np.arange(1 << 16) + above)


def _log_gamma_of(n: np.ndarray, above: float) -> np.ndarray:
    """Log of the gamma function at whole numbers and ``above``; small ones from a table."""
    known = _log_gammas(above)
    value = known[np.minimum(n, len(known) - 1)]
    large = np.flatnonzero(n >= len(known))
    value[large] = _log_gamma(n[large] + above)
    return value


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability of the counts."""
    zeros, ones = zeros.astype(np.int64), ones.astype(np.int64)
    return _log_gamma_of(zeros, 0.5) + _log_gamma_of(ones, 0.5) - _log_gamma_of(zeros + ones, 1.0) - np.log(np.pi)


class Level:
    """Nodes of one depth: sorted keys (context, bits so far), the weight of stopping here and the chance of a one."""

    def __init__(self, keys: np.ndarray, stop: np.ndarray, one: np.ndarray):
        self.keys, self.stop, self.one = keys, stop, one


def _node(context: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """A node's key: its context above eight bits of a leading one and the bits so far, seven at most."""
    return context << np.uint64(8) | prefix


def _level(node: np.ndarray, zero: np.ndarray, one: np.ndarray, children: np.ndarray | None) -> tuple[Level, np.ndarray]:
    """A level and its nodes' weighted log probabilities, from the sum of those of each node's children."""
    own = log_kt(zero, one)
    weighted = own if children is None else np.logaddexp(own, children) - np.log(2)
    stop = np.ones(len(node)) if children is None else np.exp(own - np.log(2) - weighted)
    return Level(node, stop.astype(np.float32), ((one + 0.5) / (zero + one + 1)).astype(np.float32)), weighted


def _parents(node: np.ndarray) -> np.ndarray:
    """A node's key without the oldest byte of its context."""
    return _node(node >> np.uint64(16), node & np.uint64(0xFF))


class Pairs:
    """Counted pairs of one context length: sorted keys, counts, and the place of each among those of one byte less."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, self.n, self.up = keys, n, None


def _lengths(keys: np.ndarray, n: np.ndarray, depth: int, top: int) -> list:
    """The pairs by context length from ``top`` to ``depth``, from sorted distinct keys of ``depth``."""
    found: list = [None] * depth + [Pairs(keys, n.astype(np.int64))]
    for d in range(depth, top, -1):
        shorter = _parents(found[d].keys)
        # In order but for the contexts that differ in their oldest byte alone.
        order = np.argsort(shorter, kind="stable")
        begins = _firsts(shorter[order])
        found[d].up = np.zeros(len(order), dtype=np.int64)
        found[d].up[order] = np.cumsum(begins) - 1
        shorter = shorter[order][begins]
        found[d - 1] = Pairs(shorter, np.bincount(found[d].up, weights=found[d].n, minlength=len(shorter)).astype(np.int64))
    return found


class Nodes:
    """Nodes of one context length before one bit: each pair's node, each node's first pair, counts and weights."""

    def __init__(self, pairs: Pairs, bit: int, below: Nodes | None, up: np.ndarray | None):
        prefix = pairs.keys >> np.uint64(8 - bit)
        begins = _firsts(prefix)
        self.first = np.flatnonzero(begins)
        self.of = np.cumsum(begins) - 1
        self.taken = (pairs.keys >> np.uint64(7 - bit)) & np.uint64(1) == 1
        self.total = np.add.reduceat(pairs.n, self.first) if len(prefix) else pairs.n
        self.one = np.add.reduceat(pairs.n * self.taken, self.first) if len(prefix) else pairs.n
        own = log_kt(self.total - self.one, self.one)
        if below is None:
            self.weighted, self.stop = own, np.ones(len(own))
        else:
            children = np.bincount(self.of[up[below.first]], weights=below.weighted, minlength=len(own))
            self.weighted = np.logaddexp(own, children) - np.log(2)
            self.stop = np.exp(own - np.log(2) - self.weighted)
        self.chance = (self.one + 0.5) / (self.total + 1)


def _nodes(pairs: list, bit: int, depth: int, top: int) -> list:
    found: list = [None] * (depth + 1)
    for d in range(depth, top - 1, -1):
        found[d] = Nodes(pairs[d], bit, *((found[d + 1], pairs[d + 1].up) if d < depth else (None, None)))
    return found


def build(keys: np.ndarray, n: np.ndarray, depth: int = DEPTH, top: int = SPLIT, levels: bool = True) -> tuple[list, tuple]:
    """The levels from ``top`` to ``depth`` of counted pair keys, and the seen nodes at ``top`` with weight and counts."""
    pairs = _lengths(keys, n, depth, top)
    parts: list = [[] for _ in range(depth + 1)]
    for bit in range(BITS):
        nodes = _nodes(pairs, bit, depth, top)
        for d in range(top, (depth if levels else top) + 1):
            at = nodes[d].first
            context, symbol = pairs[d].keys[at] >> np.uint64(8), pairs[d].keys[at] & np.uint64(0xFF)
            of = _node(context, symbol >> np.uint64(8 - bit) | np.uint64(1 << bit))
            seen = nodes[d].total > 0
            parts[d].append([x[seen] for x in (of, nodes[d].stop, nodes[d].chance, nodes[d].weighted, nodes[d].total - nodes[d].one, nodes[d].one)])
    out: list = [None] * (depth + 1)
    for d in range(depth, top - 1, -1):
        if parts[d]:
            node, stop, chance, *rest = map(np.concatenate, zip(*parts[d]))
            order = np.argsort(node)
            out[d] = Level(node[order], stop[order].astype(np.float32), chance[order].astype(np.float32))
    return out, (node[order], *(x[order].astype(np.float64) for x in rest))


def build_top(node: np.ndarray, weighted: np.ndarray, zero: np.ndarray, one: np.ndarray, top: int = SPLIT) -> list[Level]:
    """The levels above ``top``, from depth 0, by summing the nodes at ``top`` upwards."""
    levels = []
    for _ in range(top):
        node, at = np.unique(_parents(node), return_inverse=True)
        total = lambda x: np.bincount(at, weights=x, minlength=len(node))
        zero, one, children = total(zero), total(one), total(weighted)
        level, weighted = _level(node, zero, one, children)
        levels.insert(0, level)
    return levels


def log10_of(levels: list, keys: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Log10 probability of the byte of each key after its context."""
    out = np.zeros(len(keys))
    symbol = keys & np.uint64(0xFF)
    for bit in range(BITS):
        prefix = symbol >> np.uint64(8 - bit) | np.uint64(1 << bit)
        taken = (symbol >> np.uint64(7 - bit)) & np.uint64(1) == 1
        chance, seen = np.full(len(keys), 0.5), np.zeros(len(keys), dtype=bool)
        for d in range(depth, -1, -1):
            level = levels[d]
            if level is None or not len(level.keys):
                continue
            node = _node(keys >> np.uint64(8 * (depth + 1 - d)), prefix)
            at = np.minimum(np.searchsorted(level.keys, node), len(level.keys) - 1)
            here = level.keys[at] == node
            own = np.where(taken, level.one[at], 1 - level.one[at])
            stop = np.where(seen, level.stop[at], 1.0)
            chance = np.where(here, stop * own + (1 - stop) * chance, chance)
            seen |= here
        out += np.log10(np.maximum(chance, 1e-30))
    return out


def log10_of_pairs(keys: np.ndarray, n: np.ndarray, levels: list, depth: int = DEPTH, top: int = SPLIT) -> np.ndarray:
    """As ``log10_of`` for all of the sorted keys, those counted 0 too, with the tree built from them below the levels above ``top``.

    From the root down, what contexts of one length have mixed is carried to
    those of one byte more.
    """
    pairs = _lengths(keys, n, depth, top)
    out = np.zeros(len(keys))
    for bit in range(BITS):
        nodes = _nodes(pairs, bit, depth, top)
        short = pairs[top].keys
        # Mixed so far, the weight that is left, and chance and stopping weight of the longest context seen.
        mixed, left, chance, stop = np.zeros(len(short)), np.ones(len(short)), np.full(len(short), 0.5), np.zeros(len(short))

        def deeper(seen, one, weight, taken):
            nonlocal mixed, left, chance, stop
            mixed = np.where(seen, mixed + left * stop * chance, mixed)
            left = np.where(seen, left * (1 - stop), left)
            chance = np.where(seen, np.where(taken, one, 1 - one), chance)
            stop = np.where(seen, weight, stop)

        for d in range(top):
            level = levels[d]
            if len(level.keys):
                node = _node(short >> np.uint64(8 * (top + 1 - d)), (short & np.uint64(0xFF)) >> np.uint64(8 - bit) | np.uint64(1 << bit))
                at = np.minimum(np.searchsorted(level.keys, node), len(level.keys) - 1)
                deeper(level.keys[at] == node, level.one[at].astype(np.float64), level.stop[at].astype(np.float64), nodes[top].taken)
        for d in range(top, depth + 1):
            if d > top:
                mixed, left, chance, stop = (x[pairs[d].up] for x in (mixed, left, chance, stop))
            of = nodes[d].of
            deeper(nodes[d].total[of] > 0, nodes[d].chance[of], nodes[d].stop[of], nodes[d].taken)
        out += np.log10(np.maximum(mixed + left * chance, 1e-30))
    return out


def _packed(x: np.ndarray) -> bytes:
    """Numbers with all their first bytes together, then all second ones, compressed."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes(), codec=CODEC, asbytes=True)


def _unpacked(raw: bytes, size: int, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    flat = np.frombuffer(pa.decompress(raw, decompressed_size=size * width, codec=CODEC, asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(flat.reshape(width, size).T).view(dtype).ravel()


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Whether each of the sorted numbers is the first of its value."""
    begins = np.ones(len(ordered), dtype=bool)
    begins[1:] = ordered[1:] != ordered[:-1]
    return begins


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct keys of all, and the sums of their counts; the list is emptied."""
    keys, n = (np.concatenate(x) for x in zip(*held))
    held.clear()
    # The stable sort merges what is in order already.
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    n = n[order]
    del order
    first = np.flatnonzero(_firsts(keys))
    return [(keys[first], np.add.reduceat(n, first, dtype=np.uint32) if len(n) else n)]


def _counts(keys: np.ndarray, weight: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(_firsts(keys))
    return keys[first], (np.diff(first, append=len(keys)) * weight).astype(np.uint32)


def _asked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All distinct pair keys of a block's texts, and how often rows to learn from have them."""
    held, size = [(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint32))], 0
    for batch in table.to_batches():
        for b in chunks(batch):
            learn = b.column("learn")
            for rows, weight in ((learn, 1), (pc.invert(learn), 0)):
                held.append(_counts(pair_keys(b.filter(rows).column("text"))[0], weight))
                size += len(held[-1][0])
            if size > HELD:
                held, size = _summed(held), 0
    return _summed(held)[0]


def _in_buckets(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts keys of one bucket together, each in the order given, and where each bucket begins in it."""
    part = keys >> np.uint64(8 * (DEPTH + 1 - SPLIT))
    bucket = (mix(part) % np.uint64(n_buckets)).astype(np.uint16)
    return np.argsort(bucket, kind="stable"), np.cumsum(np.append(0, np.bincount(bucket, minlength=n_buckets)))


def _in_blocks(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows with ``block``, told by the row alone, and the number of buckets for as many blocks."""
    total = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    block = F.pmod(F.xxhash64(*rows.columns), F.lit(blocks)).alias("block")
    return rows.select(block, *rows.columns), min(32 * math.isqrt(blocks) + 32, 1 << 16)


def _requests(rows: DataFrame, n_buckets: int) -> DataFrame:
    """One row per bucket, stored: ``bucket`` and ``asked``, of each block the number of its keys, keys and counts."""

    def run(key, table):
        keys, n = _asked(table.select(["text", "learn"]))
        order, bounds = _in_buckets(keys, n_buckets)
        keys, n = keys[order], n[order]
        step = np.diff(keys, prepend=np.uint64(0))
        found = []
        for bucket in np.flatnonzero(np.diff(bounds)).tolist():
            a, b = bounds[bucket], bounds[bucket + 1]
            own = step[a:b].copy()
            own[0] = keys[a]
            found.append((key[0].as_py(), bucket, int(b - a), _packed(own), _packed(n[a:b])))
        columns = zip(*found) if found else [[]] * 5
        types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["block", "bucket", "size", "keys", "n"])

    asked = rows.select("block", "text", "learn").groupBy("block").applyInArrow(run, "block long, bucket int, size long, keys binary, n binary")
    together = asked.groupBy("bucket").agg(F.collect_list(F.struct("block", "size", "keys", "n")).alias("asked"))
    return stored(together, "tree-requests")


def _merged(asked: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's sorted distinct keys, their counts, and the place of each key that was asked."""
    keys = np.concatenate([np.cumsum(_unpacked(a["keys"], a["size"], np.uint64), dtype=np.uint64) for a in asked])
    n = np.concatenate([_unpacked(a["n"], a["size"], np.uint32) for a in asked])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = _firsts(keys)
    at = np.zeros(len(keys), dtype=np.int64)
    at[order] = np.cumsum(begins) - 1
    first = np.flatnonzero(begins)
    return keys[first], np.add.reduceat(n[order].astype(np.int64), first), at


def _stretches(keys: np.ndarray):
    """Bounds of stretches of whole parts of the tree, of about ``TOGETHER`` keys where no part is larger."""
    part = keys >> np.uint64(8 * (DEPTH + 1 - SPLIT))
    begins = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(keys)).tolist()
    a = 0
    for b, following in zip(begins[1:], [*begins[2:], math.inf]):
        if following - a > TOGETHER:
            yield a, b
            a = b


def top_levels(requests: DataFrame) -> list[Level]:
    def run(batches):
        for batch in batches:
            for asked in batch.column("asked"):
                keys, n, _ = _merged(asked.as_py())
                for a, b in _stretches(keys):
                    node, weighted, zero, one = build(keys[a:b], n[a:b], levels=False)[1]
                    yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(weighted), pa.array(zero), pa.array(one)], ["node", "weighted", "zero", "one"])

    found = requests.select("asked").mapInArrow(run, "node long, weighted double, zero double, one double").toArrow()  # bounded by the alphabet
    node = found["node"].to_numpy().view(np.uint64)
    return build_top(node, *(found[c].to_numpy() for c in ("weighted", "zero", "one")))


def _answers(requests: DataFrame, top) -> DataFrame:
    """``block, size, keys, told``: the keys that a block asked of a bucket, and their log10 probabilities above ``EVEN``."""

    def run(batches):
        for batch in batches:
            for asked in batch.column("asked"):
                asked = asked.as_py()
                keys, n, at = _merged(asked)
                told = np.zeros(len(keys), dtype=np.float32)
                for a, b in _stretches(keys):
                    told[a:b] = log10_of_pairs(keys[a:b], n[a:b], top.value) - EVEN
                told, sizes = told[at], [a["size"] for a in asked]
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([a["block"] for a in asked], pa.int64()), pa.array(sizes, pa.int64()), pa.array([a["keys"] for a in asked], pa.binary()),
                        pa.array([_packed(told[e - s : e]) for s, e in zip(sizes, ends)], pa.binary()),
                    ],
                    ["block", "size", "keys", "told"],
                )

    return requests.select("asked").mapInArrow(run, "block long, size long, keys binary, told binary")


def _told(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A block's sorted distinct keys and what the buckets answered for them."""
    lists = list(zip(*(answers[c].to_pylist() for c in ("size", "keys", "told"))))
    keys = np.concatenate([np.zeros(0, dtype=np.uint64), *(np.cumsum(_unpacked(k, n, np.uint64), dtype=np.uint64) for n, k, _ in lists)])
    told = np.concatenate([np.zeros(0, dtype=np.float32), *(_unpacked(t, n, np.float32) for n, _, t in lists)])
    order = np.argsort(keys)
    return keys[order], told[order]


def _text_sums(keys: np.ndarray, bounds: np.ndarray, known: np.ndarray, told: np.ndarray) -> np.ndarray:
    """What the answers for each text's keys add up to."""
    order = np.argsort(keys)
    keys = keys[order]
    begins = _firsts(keys)
    wanted = keys[begins]
    at = np.searchsorted(known, wanted)
    if len(wanted) and (at[-1] == len(known) or (known[at] != wanted).any()):
        raise ValueError("a text has pairs that its block did not ask for: the input changed between two readings")
    value = np.empty(len(keys))
    value[order] = told[at][np.cumsum(begins) - 1]
    return sums(value, bounds)


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The keys counted most often: a least count such that at most ``most`` keys have it."""
    step = F.floor(F.log2("n") * 16)
    steps = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)  # 16 for each doubling of the largest count
    least, total = math.inf, 0
    for s, n in steps:
        total += n
        if total > most:
            break
        least = s
    return counts.filter(step >= F.lit(float(least)))


def _sorted(df: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    pdf = df.select("key", value).toPandas()
    keys = pdf["key"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], pdf[value].to_numpy()[order]


def _look_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys the table has, and their values (0 for others)."""
    known, values = table
    if not len(known):
        return np.zeros(len(keys), dtype=bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    here = known[at] == keys
    return here, np.where(here, values[at], 0)


def _score(rows: DataFrame, most: int) -> DataFrame:
    """The scores of the rows of ``doc_id, text, learn, asked`` that are ``asked``, learning from those to ``learn`` from."""
    spark = rows.sparkSession
    training = rows.filter("learn")
    vocabulary = _counted(training, token_hashes, "tree-words")
    n_docs = training.count()
    words_total, distinct = vocabulary.agg(F.sum("n"), F.count("*")).first()
    n_train = (words_total or 0) + n_docs
    # The end is a token, too.
    floor = 0.5 * (distinct + (n_docs > 0) + 1) + n_train
    blocks, n_buckets = _in_blocks(rows)
    requests = _requests(blocks, n_buckets)
    top = spark.sparkContext.broadcast(top_levels(requests))
    sent = spark.sparkContext.broadcast(_sorted(_most_frequent(vocabulary, most), "n"))

    def run(table, answers):
        known, told = _told(answers)
        base, number, out = uuid.uuid4().int & ((1 << 62) - 1), 0, []
        end = math.log10((n_docs + 0.5) / floor)
        for batch in table.filter(table["asked"]).to_batches():
            for b in chunks(batch):
                keys, bounds = pair_keys(b.column("text"))
                total = _text_sums(keys, bounds, known, told) + np.diff(bounds) * EVEN
                tokens, at = token_hashes(b.column("text"))
                codes, unique = pd.factorize(tokens)
                here, count = _look_up(sent.value, unique)
                value = np.log10((count + 0.5) / floor) * here
                rest = np.flatnonzero(~here[codes])
                # Words that tasks do not hold, as (key, number) lists.
                both, n = np.unique((np.searchsorted(at, rest, side="right") - 1) * len(unique) + codes[rest], return_counts=True)
                ends = np.searchsorted(both, np.arange(len(at)) * len(unique))
                items = pa.StructArray.from_arrays([pa.array(unique[both % max(1, len(unique))].view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])
                rows_of = base + number + np.arange(b.num_rows)
                number += b.num_rows
                out.append(
                    pa.RecordBatch.from_arrays(
                        [
                            pa.array(rows_of), b.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64) - 1), pa.array(np.diff(at).astype(np.int64) + 1),
                            pa.array(sums(here[codes], at) + int(n_docs > 0)), pa.array(sums(value[codes], at) + end), pa.array(total),
                            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), items),
                        ],
                        fields,
                    )
                )
        return pa.Table.from_batches(out, fields)

    fields = pa.schema([(c, pa.int64()) for c in ("row", "doc_id", "n_bytes", "n_tokens", "n_known")] + [(c, pa.float64()) for c in ("base_score", "score")])
    fields = fields.append(pa.field("cold_words", pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())]))))
    schema = "row long, doc_id long, n_bytes long, n_tokens long, n_known long, base_score double, score double, cold_words array<struct<key: long, n: long>>"
    both = blocks.groupBy("block").cogroup(_answers(requests, top).groupBy("block"))
    found = stored(both.applyInArrow(run, schema), "tree-scored")
    discard(requests)
    sent.destroy()
    top.destroy()

    other_words = found.select("row", F.inline("cold_words")).join(vocabulary.select("key", F.col("n").alias("c")), "key", "left")
    count = F.coalesce("c", F.lit(0))
    word_sums = other_words.groupBy("row").agg(
        F.sum(F.log10((count + 0.5) / F.lit(floor)) * F.col("n")).alias("more_base"), F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("more_known")
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return found.join(word_sums, "row", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_known") + zero("more_known")).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base_score") + zero("more_base")).alias("base_score"), "score",
        # The end of the text is coded too.
        (-F.col("score") / math.log10(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def _marked(docs: DataFrame, learn, asked: bool) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text", learn.alias("learn"), F.lit(asked).alias("asked"))


def score(docs: DataFrame, training: DataFrame, most: int = FREQUENT) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``; scores are log10 probabilities."""
    return _score(_marked(docs, F.lit(False), True).union(_marked(training, F.lit(True), False)), most)


def score_held_out(docs: DataFrame, most: int = FREQUENT) -> DataFrame:
    """Learns from rows whose crc32 of the id modulo 5 is not 1 and scores all rows, with ``held_out``."""
    held = F.coalesce(crc32_of_id() % 5 == 1, F.lit(False))
    found = _score(_marked(docs, ~held, True), most)
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")
