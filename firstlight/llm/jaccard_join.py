"""N-gram Jaccard join by adaptive multi-match prefixes, and its connected groups.

A document's set is its distinct word shingles, as 64-bit hashes; documents of
one set are one class. Two classes link when 100 * |A & B| >= threshold * |A | B|.

All sets use one order: shingles known to be frequent stand last, by
frequency, the others by hash. A set of n shingles of which at least t must be
shared has the prefix of its first n - t + m shingles; two sets that link
share at least m shingles of their m-prefixes. Each set chooses its m by
estimated candidate cost: a longer prefix means more index rows but asks for
more shared prefix shingles before a pair is verified. A pair must share the
lesser m of the two.

Groups are found without listing all pairs in them. First each prefix shingle
pairs its holders only with the holder that has it earliest; verified links
are contracted. Then all candidate pairs that still cross components are
generated and verified, so no link between components is missed. ``pairs``
lists the links of all classes instead, and ``linked_groups`` counts them.

Index rows of two classes only meet when parity bits of their sets, which
bound in how many shingles two sets differ, leave room for a link. Candidates
are then held against histograms of their sets, which bound what two sets can
share; the sets themselves are only made and moved for the rest.

The first prefixes follow a frequency table of bounded size: the MOST_FREQUENT
commonest shingles that tasks met more than once. What it misses is learned: the
holders of prefix shingles are counted exactly, in one exchange. Of the classes
with a shingle of more than FEW_HOLDERS all shingles are counted, from the texts,
and those with more than FEW_HOLDERS move behind those not known. Every class that has one of
them in its prefix gets a new one; other prefixes stay as they are, since what
stands behind a prefix may move further back. This goes on until the pairs of
such shingles are no more than the index rows, so the join of the index grows
with the corpus and not with the square of a shingle's holders. Tasks hold the
MOST_LEARNED commonest learned shingles, so that no set is moved for these; with
more, the rest are a table, and a class looks up those of its own set by a
join. All this steers cost only: any order gives the same
links.

A null text or a text without words has an empty set and is linked with
nothing. Rows are kept one by one: repeated rows are in one class, a null
``doc_id`` never names a group unless all its ids are null. Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firstlight.llm.bloom import bloom
from firstlight.llm.components import components
from firstlight.llm.ragged import LOWER, chunks, mix, span_hashes, utf8, words
from firstlight.llm.tables import discard, free_name, screened, small_batches, stored

MOST_FREQUENT = 1 << 22
# Learned shingles that tasks hold beside these.
MOST_LEARNED = 1 << 21
FEW_HOLDERS = 4
# Rows with whole sets that a task hands to Python at once.
SET_ROWS = 1 << 8
BINS = 64
MOST_BINNED = 1 << 20
PARITY_BITS = 512
PARITY = [f"parity_{i}" for i in range(PARITY_BITS // 64)]
PREFIX = "class long, n long, m int, rare int, prefix array<long>"
MOST_MATCHES = 6
# Cost model of the choice of m: an index row, a candidate's verification per shingle,
# and the chance holders of a shingle that is not known to be frequent.
ROW_COST, VERIFY_COST, RARE_HOLDERS = 1.0, 0.05, 0.2

_FACTORS = mix(np.arange(11, 11 + 64, dtype=np.uint64)) | np.uint64(1)


def _counts(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of all sets, and in how many each is; the list is emptied."""
    tokens = np.concatenate(held)
    held.clear()
    tokens.sort()
    first = np.flatnonzero(_firsts(tokens))
    return tokens[first], np.diff(first, append=len(tokens))


def _repeated(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """As ``_counts``, those in two sets at least; arrays are made of these only."""
    tokens = np.concatenate(held)
    held.clear()
    tokens.sort()
    tokens = tokens[1:][~_firsts(tokens)[1:]]
    first = np.flatnonzero(_firsts(tokens))
    return tokens[first], np.diff(first, append=len(tokens)) + 1


def _firsts(ordered: np.ndarray) -> np.ndarray:
    begins = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=begins[1:])
    return begins


def _distinct(shingles: np.ndarray) -> np.ndarray:
    shingles = np.sort(shingles)
    return shingles[_firsts(shingles)]


def shingle_sets(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row's text."""
    data, offsets = utf8(batch.column("text"))
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    n = len(hashes)
    rolled = np.zeros(max(0, n - width + 1), dtype=np.uint64)
    for k in range(width):
        rolled += hashes[k : n - width + 1 + k] * _FACTORS[k] if n >= width else 0
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            out.append(_distinct(rolled[a : b - width + 1]))
        elif b > a:
            whole = (hashes[a:b] * _FACTORS[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(whole + _FACTORS[-1 - (b - a)]))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_hashes(sets: list[np.ndarray], factor: np.uint64 = _FACTORS[0]) -> np.ndarray:
    """One 64-bit hash of each set, whatever its order."""
    total = np.array([mix(s ^ factor).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
    return mix(total + np.array([len(s) for s in sets], dtype=np.uint64) * factor)


def histogram(shingles: np.ndarray) -> bytes:
    """How many of the shingles fall into each of BINS parts of the hash range, as 16-bit counts.

    Two sets cannot share more than the sum of the lesser counts. A set too
    large for the counts has none and is bounded by nothing.
    """
    if len(shingles) > MOST_BINNED:
        return b""
    return np.bincount((shingles % np.uint64(BINS)).astype(np.int64), minlength=BINS).astype(np.uint16).tobytes()


def parity(shingles: np.ndarray) -> np.ndarray:
    """Of each of PARITY_BITS parts of the hash range, whether it holds an odd number of the shingles; 64-bit words.

    Two sets that differ in d shingles differ in d of these bits at most.
    """
    counts = np.bincount((shingles // np.uint64(BINS) % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((counts & 1).astype(bool)).view(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def frequent_shingles(docs: DataFrame, width: int, most: int = MOST_FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` commonest shingles with more than FEW_HOLDERS, as far as tasks met them, and by how many they are held; sorted by shingle.

    Tasks report the shingles that they met more than once.
    """

    def run(batches):
        held, rows = [], 0

        def flush():
            tokens, n = _repeated(held)
            return pa.RecordBatch.from_arrays([pa.array(_signed(tokens)), pa.array(n.astype(np.int64))], ["token", "n"])

        for batch in batches:
            for b in chunks(batch):
                sets = shingle_sets(b, width)
                held += sets
                rows += sum(map(len, sets))
                if rows > 1 << 22:
                    yield flush()
                    held, rows = [], 0
        if held:
            yield flush()

    met = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("holders"))
    met = stored(met.filter(F.col("holders") > FEW_HOLDERS), "jaccard-frequent")
    found = _commonest(met, most)
    discard(met)
    return found


def least_shared(n, threshold: int):
    """The least overlap of a set of n with any set that it links with."""
    return (threshold * n + 99) // 100


def holders_of(shingles: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many hold each shingle by the sorted table; 0 if it is not in it."""
    if not len(keys):
        return np.zeros(len(shingles), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
    return np.where(keys[at] == shingles, counts[at], 0)


def prefix(shingles: np.ndarray, holders: np.ndarray, threshold: int) -> tuple[np.ndarray, int, int]:
    """The set's first shingles in the common order, as many as its chosen m needs, m, and how many of them are not known."""
    n = len(shingles)
    t = int(least_shared(n, threshold))
    order = np.lexsort((shingles, holders))
    known = holders[order]
    cost = np.where(known == 0, RARE_HOLDERS, known - 1.0)
    m = np.arange(1, min(MOST_MATCHES, t) + 1)
    sizes = n - t + m
    candidates = np.cumsum(cost)[sizes - 1]
    best = int(np.argmin(ROW_COST * sizes + candidates + VERIFY_COST * n * candidates / m))
    first = order[: sizes[best]]
    return shingles[first], int(m[best]), int((holders[first] == 0).sum())


def classes(docs: DataFrame, width: int, threshold: int, keys: np.ndarray, counts: np.ndarray) -> DataFrame:
    """``doc_id, n, class, m, rare, bins, prefix`` and ``PARITY``: the hash of each row's set, its choice of m, its histogram, prefix and parity bits.

    The first ``rare`` shingles of the prefix are not in the frequency table.
    """
    sent = docs.sparkSession.sparkContext.broadcast((keys, counts))

    def run(batches):
        known, holders = sent.value
        for batch in batches:
            for b in chunks(batch):
                sets = shingle_sets(b, width)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                chosen = [prefix(s, holders_of(s, known, holders), threshold) if len(s) else (s, 0, 0) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id"), pa.array(n), pa.array(_signed(set_hashes(sets))),
                        pa.array([m for _, m, _ in chosen], pa.int32()), pa.array([r for _, _, r in chosen], pa.int32()),
                        pa.array([histogram(s) for s in sets], pa.binary()), pa.array([_signed(p) for p, _, _ in chosen], pa.list_(pa.int64())),
                        *map(pa.array, np.array([parity(s) for s in sets]).T),
                    ],
                    ["doc_id", "n", "class", "m", "rare", "bins", "prefix", *PARITY],
                )

    schema = ", ".join(["doc_id long, n long, class long, m int, rare int, bins binary, prefix array<long>", *(f"{p} long" for p in PARITY)])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _rows(found: DataFrame) -> DataFrame:
    """Index rows ``token, at, n, class, m, rare, met``, stored, of shingles held by at least two classes.

    Most prefix shingles are held once; a filter of those met twice or more
    drops them before any row is made, and an exact test follows. ``met`` is
    how many shared shingles the set has before ``at``; the others there are
    its own alone.
    """
    keys = found.select(F.col("prefix").alias("keys"))
    n_keys = keys.agg(F.sum(F.size("keys"))).first()[0] or 0
    sent = found.sparkSession.sparkContext.broadcast(bloom(keys, n_keys, least=2))

    def run(batches):
        for b in batches:
            lists = b.column("prefix")
            tokens = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(lists.offsets.to_numpy())
            keep = np.flatnonzero(sent.value.contains(tokens))
            row = np.repeat(np.arange(b.num_rows), sizes)[keep]
            at = keep - (np.cumsum(sizes) - sizes)[row]
            of = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[keep]), pa.array(at.astype(np.int32)), b.column("n").take(of), b.column("class").take(of), b.column("m").take(of), b.column("rare").take(of)],
                ["token", "at", "n", "class", "m", "rare"],
            )

    rows = found.select("n", "class", "m", "rare", "prefix").mapInArrow(run, "token long, at int, n long, class long, m int, rare int")
    rows = stored(rows.dropDuplicates(["token", "class"]), "jaccard-rows")
    sent.destroy()
    shared = rows.groupBy("token").agg(F.count("*").alias("holders")).filter("holders > 1")
    met = F.row_number().over(Window.partitionBy("class").orderBy("at")) - 1
    found = stored(rows.join(shared, "token").drop("holders").withColumn("met", met), "jaccard-met")
    discard(rows)
    return found


def _fits(x: str, y: str, threshold: int):
    """Length and position bounds of a pair that shares a shingle: what can still be shared is enough."""
    c = lambda side, name: F.col(f"{side}.{name}")
    need = F.ceil((c(x, "n") + c(y, "n")) * threshold / (100 + threshold))
    can = F.least(c(x, "n") - c(x, "at"), c(y, "n") - c(y, "at")) + F.least(c(x, "met"), c(y, "met"))
    sizes = (F.least(c(x, "n"), c(y, "n")) * 100 >= F.greatest(c(x, "n"), c(y, "n")) * threshold)
    return sizes & (can >= need)


def _near(x: str, y: str, threshold: int):
    """The pair's parity bits leave room for a link: sets that share i of n shingles together differ in n - 2 i."""
    n = F.col(f"{x}.n") + F.col(f"{y}.n")
    differ = sum((F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))).cast("long") for p in PARITY), F.lit(0).cast("long"))
    return (n - differ) * (100 + threshold) >= n * (2 * threshold)


def _with_parity(rows: DataFrame, found: DataFrame) -> DataFrame:
    met = rows.select("class").distinct()
    bits = found.select("class", *PARITY).join(met, "class", "left_semi").dropDuplicates(["class"])
    return rows.join(bits, "class")


def _pairs(joined: DataFrame, threshold: int) -> DataFrame:
    """Pairs that share the lesser m of the two inside both their prefixes for it."""
    m = F.least("x.m", "y.m")
    inside = lambda s: F.col(f"{s}.at") < F.col(f"{s}.n") - F.floor((F.col(f"{s}.n") * threshold + 99) / 100) + m
    kept = joined.filter(_fits("x", "y", threshold) & inside("x") & inside("y"))
    one = kept.select(F.least("x.class", "y.class").alias("u"), F.greatest("x.class", "y.class").alias("v"), m.alias("m"), "x.token")
    return one.groupBy("u", "v", "m").agg(F.count_distinct("token").alias("shared")).filter("shared >= m").select("u", "v")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``class, tokens``: the sets of the wanted documents, one row per class.

    A filter of the wanted rows keeps most other documents' sets from being
    shuffled; the few that it lets through are sets of their classes too.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_filter(wanted))

    def run(batches):
        for batch in batches:
            for b in chunks(batch):
                sets, own = _own(b, width, sent.value)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["class", "tokens"])

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "class long, tokens binary")
    return made.dropDuplicates(["class"])


def _possible(pairs: DataFrame, found: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose histograms leave room for a link; an exact bound that needs no set to be moved."""
    met = pairs.select(F.col("u").alias("class")).union(pairs.select("v")).distinct()
    bins = found.select("class", "n", "bins").join(met, "class", "left_semi").dropDuplicates(["class"])
    side = lambda c: bins.select(F.col("class").alias(c), F.col("n").alias(f"n_{c}"), F.col("bins").alias(f"bins_{c}"))

    def run(batches):
        for b in batches:
            columns = [b.column(c).to_pylist() for c in ("bins_u", "bins_v")]
            small = np.array([bool(x) and bool(y) for x, y in zip(*columns)], dtype=bool)
            x, y = (np.frombuffer(b"".join(v for v, ok in zip(c, small) if ok), dtype=np.uint16).reshape(-1, BINS) for c in columns)
            n = b.column("n_u").to_numpy() + b.column("n_v").to_numpy()
            keep = np.ones(b.num_rows, dtype=bool)
            keep[small] = (100 + threshold) * np.minimum(x, y).sum(axis=1, dtype=np.int64) >= threshold * n[small]
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([b.column("u").take(at), b.column("v").take(at)], ["u", "v"])

    return pairs.join(side("u"), "u").join(side("v"), "v").mapInArrow(run, "u long, v long")


def _verified(pairs: DataFrame, docs: DataFrame, found: DataFrame, width: int, threshold: int) -> DataFrame:
    """The pairs whose sets link, stored; only sets of classes in a pair are made and moved."""
    candidates = stored(pairs, "jaccard-candidates")
    pairs = stored(_possible(candidates, found, threshold), "jaccard-pairs")
    discard(candidates)
    met = pairs.select(F.col("u").alias("class")).union(pairs.select("v")).distinct()
    wanted = found.join(met, "class", "left_semi").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    wanted = stored(wanted, "jaccard-wanted")
    sets = stored(_sets(docs, wanted, width), "jaccard-sets")
    discard(wanted)

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("a"), b.column("b")):
                p, q = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                both = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
                keep.append(100 * both >= threshold * (len(p) + len(q) - both))
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([b.column("u").take(at), b.column("v").take(at)], ["u", "v"])

    a = sets.select(F.col("class").alias("u"), F.col("tokens").alias("a"))
    b = sets.select(F.col("class").alias("v"), F.col("tokens").alias("b"))
    with small_batches(docs.sparkSession, SET_ROWS):
        links = stored(pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long"), "jaccard-links")
    discard(pairs, sets)
    return links


def _chosen(full: DataFrame, wanted: DataFrame):
    """A filter of one row of each wanted class, for ``_own``: its least ``doc_id``."""
    least = full.join(wanted, "class", "left_semi").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    least = stored(least, "jaccard-chosen")
    found = _filter(least)
    discard(least)
    return found


def _filter(rows: DataFrame):
    """A filter of ``class, doc_id``, for ``_own``."""
    keys = F.array(F.col("class").bitwiseXOR(F.coalesce("doc_id", F.lit(0).cast("long"))))
    return bloom(rows.select(keys.alias("keys")), rows.count())


def _own(batch: pa.RecordBatch, width: int, chosen) -> tuple[list[np.ndarray], np.ndarray]:
    """The sets and classes of the batch's chosen rows; now and then of another one, or of two of a class."""
    sets = shingle_sets(batch, width)
    own = _signed(set_hashes(sets))
    ids = pc.fill_null(batch.column("doc_id"), 0).to_numpy()
    at = np.flatnonzero(chosen.contains(own ^ ids) & np.array([len(s) > 0 for s in sets], dtype=bool))
    return [sets[i] for i in at.tolist()], own[at]


def _counted(docs: DataFrame, width: int, chosen, keys: np.ndarray, counts: np.ndarray) -> DataFrame:
    """``token, holders``: shingles of the chosen rows that are not in the table and have more than FEW_HOLDERS; counted in each task first."""
    sent = docs.sparkSession.sparkContext.broadcast((chosen, keys, counts))

    def run(batches):
        chosen, *table = sent.value
        held, size = [], 0

        def flush():
            tokens, n = _counts(held)
            new = holders_of(tokens, *table) == 0
            return pa.RecordBatch.from_arrays([pa.array(_signed(tokens[new])), pa.array(n[new].astype(np.int64))], ["token", "n"])

        for batch in batches:
            for b in chunks(batch):
                sets = _own(b, width, chosen)[0]
                held += sets
                size += sum(map(len, sets))
                if size > 1 << 22:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    met = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "token long, n long")
    return met.groupBy("token").agg(F.sum("n").alias("holders")).filter(F.col("holders") > FEW_HOLDERS)


def _commonest(counted: DataFrame, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ``token, holders`` those with the most holders, sorted by token: a least number such that at most ``room`` have it."""
    step = F.floor(F.log2("holders") * 16)
    least, total = None, 0
    for s, n in sorted(counted.groupBy(step.alias("step")).count().collect(), reverse=True):  # 16 for each doubling of the largest number
        total += n
        if total > room:
            break
        least = s
    if least is None:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    found = counted.filter(step >= F.lit(float(least))).select("token", "holders").toArrow()  # at most `room` rows
    tokens, holders = found["token"].to_numpy().view(np.uint64), found["holders"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], holders[order]


def _holding(state: DataFrame, keys: np.ndarray) -> DataFrame:
    """``class`` of those with one of the keys in their prefix, from the table that tasks hold."""
    sent = state.sparkSession.sparkContext.broadcast(keys.view(np.int64))

    def run(batches):
        known = np.sort(sent.value)
        for b in batches:
            lists = b.column("prefix")
            tokens, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
            hit = known[np.minimum(np.searchsorted(known, tokens), len(known) - 1)] == tokens
            at = np.unique(np.repeat(np.arange(b.num_rows), sizes)[hit])
            yield pa.RecordBatch.from_arrays([b.column("class").take(pa.array(at, pa.int64()))], ["class"])

    return state.select("class", "prefix").mapInArrow(run, "class long").distinct()


def _again(docs: DataFrame, width: int, threshold: int, chosen, keys: np.ndarray, counts: np.ndarray) -> DataFrame:
    """``class, n, m, rare, prefix`` of the chosen rows by the table that tasks hold; no set is moved."""
    sent = docs.sparkSession.sparkContext.broadcast((chosen, keys, counts))

    def run(batches):
        chosen, *table = sent.value
        for batch in batches:
            for b in chunks(batch):
                sets, own = _own(b, width, chosen)
                yield _prefixes(own, sets, [prefix(s, holders_of(s, *table), threshold) for s in sets])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PREFIX).dropDuplicates(["class"])


def _prefixes(own, sets: list[np.ndarray], chosen: list[tuple[np.ndarray, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(own, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([m for _, m, _ in chosen], pa.int32()),
            pa.array([r for _, _, r in chosen], pa.int32()), pa.array([_signed(p) for p, _, _ in chosen], pa.list_(pa.int64())),
        ],
        ["class", "n", "m", "rare", "prefix"],
    )


def _learned(docs: DataFrame, width: int, chosen, known: DataFrame) -> DataFrame:
    """``class, shingles, holders``: what is known of each chosen row's shingles; ``known`` is ``token, holders``."""
    sent = docs.sparkSession.sparkContext.broadcast((chosen, bloom(known.select(F.array("token").alias("keys")), known.count())))

    def run(batches):
        chosen, screen = sent.value
        for batch in batches:
            for b in chunks(batch):
                sets, own = _own(b, width, chosen)
                tokens = _signed(np.concatenate([*sets, np.zeros(0, dtype=np.uint64)]))
                keep = np.flatnonzero(screen.contains(tokens))
                of = np.repeat(own, [len(s) for s in sets])[keep]
                yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array(tokens[keep])], ["class", "token"])

    met = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "class long, token long")
    both = met.join(known, "token").groupBy("class").agg(F.collect_set(F.struct("token", "holders")).alias("of"))
    return both.select("class", F.col("of.token").alias("shingles"), F.col("of.holders").alias("holders"))


def _renewed(docs: DataFrame, width: int, threshold: int, chosen, learned: DataFrame, keys: np.ndarray, counts: np.ndarray) -> DataFrame:
    """``class, n, m, rare, prefix`` of the chosen rows, by the table that tasks hold and what each has learned."""
    sent = docs.sparkSession.sparkContext.broadcast((chosen, keys, counts))

    def sets(batches):
        for batch in batches:
            for b in chunks(batch):
                found, own = _own(b, width, sent.value[0])
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], ["class", "tokens"])

    def run(batches):
        table = sent.value[1:]
        for b in batches:
            own, out = [], []
            for raw, shingles, holders in zip(b.column("tokens"), b.column("shingles"), b.column("holders")):
                own.append(np.frombuffer(raw.as_buffer(), dtype=np.uint64))
                met = shingles.values.to_numpy(zero_copy_only=False).view(np.uint64)
                order = np.argsort(met)
                count = holders_of(own[-1], *table) + holders_of(own[-1], met[order], holders.values.to_numpy(zero_copy_only=False)[order])
                out.append(prefix(own[-1], count, threshold))
            yield _prefixes(b.column("class"), own, out)

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sets, "class long, tokens binary")
    lists = [F.coalesce(c, F.array().cast("array<long>")).alias(c) for c in ("shingles", "holders")]
    return made.join(learned, "class", "left").select("class", "tokens", *lists).mapInArrow(run, PREFIX).dropDuplicates(["class"])


def _indexed(docs: DataFrame, width: int, threshold: int, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The classes of all rows, those with a set, and the index rows of these.

    Only classes that share a shingle of their first prefixes can link, so the
    later ones are made among these.
    """
    keys, counts = frequent_shingles(docs, width, most)
    found = stored(classes(docs, width, threshold, keys, counts), "jaccard-classes")
    full = found.filter("n > 0")
    rows = _rows(full)
    state, known, room = None, None, MOST_LEARNED
    while True:
        often = rows.filter("at < rare").groupBy("token").agg(F.count("*").alias("holders")).filter(F.col("holders") > FEW_HOLDERS)
        often = stored(often, "jaccard-often")
        n_pairs = often.agg(F.sum(F.col("holders") * (F.col("holders") - 1) / 2)).first()[0] or 0
        if n_pairs <= rows.count():
            break
        if state is None:
            state = full.select("class", "n", "m", "rare", "prefix").join(rows.select("class").distinct(), "class", "left_semi")
            state = stored(state, "jaccard-state")
        touched = stored(rows.filter("at < rare").join(often.select("token"), "token", "left_semi").select("class").distinct(), "jaccard-touched")
        counted = _counted(docs, width, _chosen(full, touched), keys, counts)
        counted = stored(counted if known is None else counted.join(known.select("token"), "token", "left_anti"), "jaccard-learned")
        discard(often, touched, rows)
        new = _commonest(counted, room)
        if len(new[0]):
            room -= len(new[0])
            keys, counts = np.concatenate([keys, new[0]]), np.concatenate([counts, new[1]])
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            touched = stored(_holding(state, new[0]), "jaccard-touched")
            discard(counted)
        else:
            known = counted if known is None else known.union(counted)
            fronts = state.select("class", F.explode(F.slice("prefix", 1, F.col("rare"))).alias("token"))
            touched = stored(fronts.join(counted.select("token"), "token", "left_semi").select("class").distinct(), "jaccard-touched")
        chosen = _chosen(full, touched)
        if known is None:
            renewed = _again(docs, width, threshold, chosen, keys, counts)
        else:
            learned = stored(_learned(docs, width, chosen, known), "jaccard-known")
            renewed = _renewed(docs, width, threshold, chosen, learned, keys, counts)
        with small_batches(docs.sparkSession, SET_ROWS):
            renewed = stored(renewed.join(touched, "class", "left_semi"), "jaccard-renewed")
        last, state = state, stored(state.join(touched, "class", "left_anti").union(renewed), "jaccard-state")
        discard(last, touched, renewed, learned if known is not None else None)
        rows = _rows(state)
    discard(often, state)
    return found, full, rows


def _all_links(docs: DataFrame, full: DataFrame, rows: DataFrame, width: int, threshold: int) -> DataFrame:
    """``u, v`` with u < v: all classes of different sets that link, as a stored table."""
    bare, rows = rows, stored(_with_parity(rows, full), "jaccard-open")
    near = _fits("x", "y", threshold) & _near("x", "y", threshold)
    both = rows.alias("x").join(rows.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.class") < F.col("y.class")) & near)
    links = _verified(_pairs(both, threshold), docs, full, width, threshold)
    discard(bare, rows)
    return links


def pairs(docs: DataFrame, width: int = 5, threshold: int = 80, most: int = MOST_FREQUENT) -> tuple[DataFrame, DataFrame]:
    """All links ``u, v`` between classes of different sets, and the ``doc_id, class`` of every row that has a set.

    Rows of one class are linked with each other and have the links of their
    class; the number of pairs grows with the square of a group of near copies.
    """
    _, full, rows = _indexed(docs, width, threshold, most)
    return _all_links(docs, full, rows, width, threshold), full.select("doc_id", "class")


def linked_groups(docs: DataFrame, width: int = 5, threshold: int = 80, most: int = MOST_FREQUENT) -> DataFrame:
    """As ``groups``, from the list of all links, with ``n_links``: how many other rows each row is linked with."""
    found, full, rows = _indexed(docs, width, threshold, most)
    links = _all_links(docs, full, rows, width, threshold)
    sizes = full.groupBy("class").agg(F.count("*").alias("size"))
    ends = links.union(links.select("v", "u")).toDF("class", "other").join(sizes.withColumnRenamed("class", "other"), "other")
    linked = ends.groupBy("class").agg(F.sum("size").alias("linked"))
    n_links = F.when(F.col("n_shingles") == 0, 0).otherwise(F.col("class_size") - 1 + F.coalesce("linked", F.lit(0))).cast("long")
    rows_of = _grouped(found, full, stored(components(links), "jaccard-components"))
    return rows_of.join(linked, "class", "left").select("doc_id", "n_shingles", "component_id", "class_size", n_links.alias("n_links"))


def groups(docs: DataFrame, width: int = 5, threshold: int = 80, most: int = MOST_FREQUENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, class_size``.

    ``component_id`` is the smallest ``doc_id`` reachable by links, the
    document's own included; ``class_size`` the number of rows with its set.
    """
    return _groups(docs, width, threshold, most)[0]


def _groups(docs: DataFrame, width: int, threshold: int, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """``groups``, and the stored tables that it reads."""
    found, full, rows = _indexed(docs, width, threshold, most)
    first = rows.groupBy("token").agg(F.min(F.struct("at", "class", "n", "m", "met")).alias("f")).select("token", "f.*")
    star = rows.alias("x").join(first.alias("y"), F.col("x.token") == F.col("y.token")).filter("x.class <> y.class")
    links = _verified(_pairs(star, threshold), docs, full, width, threshold)
    labels = stored(components(links), "jaccard-labels")

    labelled = rows.join(labels, rows["class"] == labels["node"], "left").select(rows["*"], F.coalesce("root", "class").alias("root"))
    labelled = stored(labelled, "jaccard-labelled")
    discard(rows, labels)
    open_tokens = labelled.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("token")
    still = stored(_with_parity(labelled.join(open_tokens, "token", "left_semi"), full), "jaccard-open")
    discard(labelled)
    crossing = still.alias("x").join(
        still.alias("y"),
        (F.col("x.token") == F.col("y.token")) & (F.col("x.class") < F.col("y.class")) & (F.col("x.root") != F.col("y.root"))
        & _fits("x", "y", threshold) & _near("x", "y", threshold),
    )
    more = _verified(_pairs(crossing, threshold), docs, full, width, threshold)
    discard(still)
    labels = stored(components(links.union(more)), "jaccard-components")
    discard(links, more)
    return _grouped(found, full, labels).drop("class"), [found, labels]


def _grouped(found: DataFrame, full: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_size, class`` of every row."""
    member = full.select("doc_id", "n", "class").join(labels, F.col("class") == F.col("node"), "left")
    member = member.select("doc_id", "n", "class", F.coalesce("root", "class").alias("root"))
    least = member.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    sizes = member.groupBy("class").agg(F.count("*").alias("class_size"))
    linked = member.join(least, "root").join(sizes, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_size", "class")
    alone = found.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("class_size"), "class")
    return linked.union(alone)


def one_of_each(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the smallest of their group, with all their columns.

    Only rows that may have the id of one that goes are shuffled.
    """
    stay_id = free_name(docs, "stay_id")
    found, read = _groups(docs, width, threshold, MOST_FREQUENT)
    kept = stored(found.select("doc_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("stays")).distinct(), "jaccard-kept")
    discard(*read)
    doc_id = F.col("doc_id").cast("long")
    first, others = screened(docs, [doc_id], kept.filter("not stays").select("doc_id"))
    stays = kept.filter("stays").select(F.col("doc_id").alias(stay_id))
    return first.unionByName(others.join(stays, doc_id.eqNullSafe(F.col(stay_id)), "left_semi"))
