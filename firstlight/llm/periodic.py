"""Periodic runs of words, by enumerating maximal pairs.

A run is a stretch of consecutive words with smallest period q and a length of
at least max(least, 3 * q) that no neighbouring word extends. It is a maximal
pair: with start a and end b the words from a and from a + q agree for exactly
l = b - a - q words, and differ before and after. The other way round, every
maximal pair of places p apart that agrees for l words, with 2 * p <= l and
p + l >= least, is a maximal stretch of period p as it stands: nothing has to
be extended. Where p is a multiple of the smallest period the same stretch
comes from the smaller distance too, so the least distance of a stretch counts.

The pairs come from the tree of LCP intervals of a document's suffixes, walked
from the leaves up. A node with common length l joins the places of its
children; for each place of the smaller side those of the larger side are
looked up that lie within l / 2. Places so near are occurrences of one
periodic string, all one period apart. Their left words then fall into two
classes at most: the lowest place alone can differ from the rest. So the class
lists of a node are one list in order of place with the left word beside each,
and one look-up to either side finds every pair of different classes.

Pairs that can be runs agree for two thirds of ``least`` words or more. A
document in which no stretch of that length is repeated has no suffix in the
tree and is passed over.

Words are ``[^\\x20\\x09-\\x0D]+`` and compared by 64-bit hash. A null text has
no words. Every row is taken by itself: repeated rows and null ids are kept,
other columns ignored. Memory is that of one text, about 100 bytes a word.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstlight.llm.ragged import chunks, joined, mix, span_hashes, texts, utf8, words

LEAST = 24
# Words of documents with repeats that are sorted together.
SORTED_WORDS = 1 << 18

_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shortest_pair(least: int) -> int:
    """The least common length of a pair that can be a run: 2 * p <= l and p + l >= least."""
    return -(-2 * least // 3)


def repeated(hashes: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` words from each word on occur again; ``ends`` is each word's end of text.

    Words of different texts have different hashes here.
    """
    n, spans, width = len(hashes), hashes, 1
    while 2 * width <= length:
        spans, width = _follow(spans, width), 2 * width
    if width < length:
        spans = _follow(spans, length - width)
    whole = np.flatnonzero(np.arange(n) + length <= ends)
    order = np.argsort(spans[whole], kind="stable")
    ordered = spans[whole][order]
    same = np.zeros(len(order) + 1, dtype=bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    out = np.zeros(n, dtype=bool)
    out[whole[order]] = same[1:] | same[:-1]
    return out


def _follow(spans: np.ndarray, by: int) -> np.ndarray:
    """Hash of each span with the one ``by`` words further on."""
    out = spans * _FIRST
    out[:-by] += mix(spans[by:]) * _SECOND
    return mix(out)


def suffix_order(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes in an order that keeps common beginnings together, and the rank of each by its first 2^k words.

    Prefix doubling; from round to round only suffixes that are not told apart
    yet are sorted again.
    """
    n = len(hashes)
    _, rank = np.unique(hashes, return_inverse=True)
    counts = np.bincount(rank)
    rank = (np.cumsum(counts) - counts)[rank]
    ranks, open_, step = [rank.astype(np.int32)], np.flatnonzero(counts[np.searchsorted(np.cumsum(counts), rank, side="right")] > 1), 1
    while len(open_):
        further = open_ + step
        second = np.where(further < ends[open_], rank[np.minimum(further, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + second
        order = np.argsort(key)
        open_, key = open_[order], key[order]
        old = rank[open_]
        at = np.arange(len(open_))
        new_key = np.diff(key, prepend=-1) != 0
        new_old = np.diff(old, prepend=-1) != 0
        begins = np.maximum.accumulate(np.where(new_key, at, 0))
        rank = rank.copy()
        rank[open_] = old + begins - np.maximum.accumulate(np.where(new_old, at, 0))
        alone = new_key & np.append(new_key[1:], True)
        open_, step = open_[~alone], 2 * step
        ranks.append(rank.astype(np.int32))
    return np.argsort(rank), ranks


def common_lengths(x: np.ndarray, y: np.ndarray, ends: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """How many words the suffixes at x and y have in common."""
    n, found = len(ends), np.zeros(len(x), dtype=np.int64)
    end_x, end_y = ends[x], ends[y]
    for k in range(len(ranks) - 1, -1, -1):
        a, b = x + found, y + found
        same = (a < end_x) & (b < end_y)
        same &= ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)]
        found += same.astype(np.int64) << k
    return found


def maximal_pairs(places: list[int], common: list[int], left: list[int], least: int) -> dict[tuple[int, int], int]:
    """``(start, end)`` of the runs and their periods.

    ``places`` are suffixes in order, ``common`` the length that each has in
    common with the one before (0 where that is too short to matter), ``left``
    the class of the word before each place of the text.
    """
    found: dict[tuple[int, int], int] = {}

    def report(start: int, distance: int, length: int) -> None:
        stretch = (start, start + distance + length)
        if found.get(stretch, distance) >= distance:
            found[stretch] = distance

    def join(a: list[int], b: list[int], length: int) -> list[int]:
        small, large = (a, b) if len(a) < len(b) else (b, a)
        near, far = max(1, least - length), length // 2
        if near <= far:
            last = len(large)
            for x in small:
                i = bisect_left(large, x - far)
                if i < last and large[i] <= x - near and left[large[i]] != left[x]:
                    report(large[i], x - large[i], length)
                i = bisect_left(large, x + near, i)
                if i < last and large[i] <= x + far and left[large[i]] != left[x]:
                    report(x, large[i] - x, length)
        if 8 * len(small) > len(large):
            large += small
            large.sort()
        else:
            for x in small:
                insort(large, x)
        return large

    open_: list[tuple[int, list[int]]] = []
    now: list[int] = []
    for place, length in zip(places, common):
        while open_ and open_[-1][0] > length:
            above, before = open_.pop()
            now = join(before, now, above)
        if length:
            open_.append((length, now))
        now = [place]
    while open_:
        above, before = open_.pop()
        now = join(before, now, above)
    return found


def word_runs(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``start, end, period`` over all words, by start and period, and how many of them begin before each text."""
    n_texts, sizes = len(bounds) - 1, np.diff(bounds)
    text_of = np.repeat(np.arange(n_texts), sizes)
    own = mix(hashes ^ mix(text_of.astype(np.uint64) + np.uint64(1)))
    shortest = shortest_pair(least)
    again = repeated(own, np.repeat(bounds[1:], sizes), shortest)
    counts = np.bincount(text_of[again], minlength=n_texts)
    rows: list[tuple[int, int, int]] = []
    group, held = [], 0
    chosen = np.flatnonzero(counts)
    for at, t in enumerate(chosen):
        group.append(t)
        held += sizes[t]
        if held >= SORTED_WORDS or at == len(chosen) - 1:
            rows += _runs_of(own, bounds, np.array(group), shortest, least)
            group, held = [], 0
    runs = np.array(sorted(rows, key=lambda r: (r[0], r[2])), dtype=np.int64).reshape(-1, 3)
    return runs, np.searchsorted(runs[:, 0], bounds)


def _runs_of(own: np.ndarray, bounds: np.ndarray, group: np.ndarray, shortest: int, least: int) -> list[tuple[int, int, int]]:
    sizes = bounds[group + 1] - bounds[group]
    begins = np.cumsum(sizes) - sizes
    shift = np.repeat(bounds[group] - begins, sizes)
    hashes = own[np.arange(len(shift)) + shift]
    ends = np.repeat(begins + sizes, sizes)
    order, ranks = suffix_order(hashes, ends)
    common = np.zeros(len(order), dtype=np.int64)
    level = shortest.bit_length() - 1  # equal by at most `shortest` words: the pairs worth measuring
    near = np.flatnonzero(ranks[min(level, len(ranks) - 1)][order[1:]] == ranks[min(level, len(ranks) - 1)][order[:-1]]) + 1
    common[near] = common_lengths(order[near - 1], order[near], ends, ranks)
    common[common < shortest] = 0
    used = common > 0
    used[:-1] |= common[1:] > 0
    left = np.empty(len(hashes), dtype=np.int64)
    left[1:] = ranks[0][:-1]
    left[begins] = -1
    pairs = maximal_pairs(order[used].tolist(), common[used].tolist(), left.tolist(), least)
    moved = shift.tolist()
    return [(a + moved[a], b + moved[a], q) for (a, b), q in pairs.items()]


def runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, runs, collapsed`` of every row.

    ``runs`` are the text's runs ``start, length, period`` by start and
    period, in word numbers from 0. ``collapsed`` are the words that stay,
    joined by one space, when of each run only the first period is kept.
    """

    def run(batches):
        for batch in batches:
            for b in chunks(batch):
                data, offsets = utf8(b.column("text"))
                starts, ends, bounds = words(data, offsets)
                found, of_text = word_runs(span_hashes(data, starts, ends), bounds, least)
                covered = np.zeros(len(starts) + 1, dtype=np.int64)
                np.add.at(covered, found[:, 0] + found[:, 2], 1)
                np.add.at(covered, found[:, 1], -1)
                kept, firsts = joined(data, starts, ends, bounds, np.cumsum(covered[:-1]) == 0)
                base = bounds[np.searchsorted(bounds, found[:, 0], side="right") - 1]
                row = pa.StructArray.from_arrays([pa.array(found[:, 0] - base), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])], ["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), row)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists, texts(kept, firsts).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    schema = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def strongest(found: Column) -> Column:
    """The run with the greatest length / period, the first of equals; compared by cross products, so exactly."""
    better = lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)
    return F.reduce(F.slice(found, 2, F.greatest(F.size(found), F.lit(0))), F.get(found, 0), better)


def digests(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, n_runs``, the strongest run ``start, length, period, exponent_milli``, and digests of all runs and of the collapsed text."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    made = runs(docs, least).select("doc_id", "runs", "collapsed", strongest(F.col("runs")).alias("top"))
    return made.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"top.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: the texts of one document in ten with a periodic tail written over their own.

    With h = crc32 of the decimal ``doc_id`` and g = h / 10, where h % 10 = 0
    the words from a = g % n on repeat the p = 1 + (n - a) / (3 + g % 8) words
    from a. A null ``doc_id`` has no tail.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    parted = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    tailed = docs.select("doc_id", "text", F.when(h % 10 == 0, parted).alias("w"), F.floor(h / 10).alias("g"))
    n = F.nullif(F.size("w"), F.lit(0))
    begin = (F.col("g") % n).cast("int")
    period = F.lit(1) + F.floor((n - begin) / (F.lit(3) + F.col("g") % 8)).cast("int")
    tailed = tailed.select("doc_id", "text", "w", F.when(F.col("w").isNotNull(), begin).alias("a"), F.when(F.col("w").isNotNull(), period).alias("p"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    tail = F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", place(i)))
    return tailed.select("doc_id", F.when(F.col("p").isNotNull(), F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))
