"""Ranked lexical search by NRA: impact-sorted lists, read in order only.

A query's terms each have a list of the documents that hold them, sorted by
what the term adds to the document's score. NRA reads the lists from their
heads and never looks a document up. For each document met it keeps an
interval: the lower end adds up what was read, the upper end adds for every
list in which it was not met yet the value at that list's reading position.
Reading goes on until no unmet document can come into the best ``k``, and every
document whose upper end reaches the k-th lower end has a closed interval. So
membership, order, ties and scores are final, without a later look-up.

The score of a document is the sum over the query's distinct terms of
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` in 64-bit integers, with
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and
``m = 10 + (90 * n * N) div L``; N counts the documents with a term, L all
terms, n those of the document.

Documents are the parallel side. A first pass turns each text into the numbers
of its query terms and how often they occur, as a table; it holds all counts
that df, N and L need. In the second pass a task takes its documents in pieces
of bounded size, sorts the lists of a piece and runs each query on it; the k-th
best score of the pieces before is where the next one's reading can stop
early. What leaves a task is k rows a query, so a common term or a source with
a third of all documents costs no shuffle.

Queries are taken in blocks of ``BLOCK_TERMS`` terms, so that what tasks hold
of them is bounded however many there are; each block is one run over the
documents, as each query has to see all of them.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``
with A-Z lower-cased, compared by 64-bit hash. A null text has no terms.
Documents without a query term have score 0 and are never found. Every row is
its own document or its own query, repeated rows and null ids too; equal
scores are ordered by ascending ``doc_id``, nulls last. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firstlight.llm.ragged import LOWER, chunks, span_hashes, utf8, words
from firstlight.llm.tables import stored

BLOCK_TERMS = 1 << 18
# A piece of documents whose lists are sorted together ends at either bound.
PIECE_DOCS, PIECE_POSTINGS = 1 << 15, 1 << 21
# Entries read from each list in the first round; every round reads four times as many.
FIRST_READ = 256

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[:0x80] = True
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    SEPARATORS[_first : _last + 1] = False


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all terms of the texts in order, and how many stand before each text."""
    data, offsets = utf8(column)
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets, SEPARATORS)
    return span_hashes(data, starts, ends), bounds


def query_terms(items: DataFrame) -> DataFrame:
    """``item_id, terms``: the distinct term hashes of each query."""

    def run(batches):
        for batch in batches:
            for b in chunks(batch):
                hashes, bounds = term_hashes(b.column("text"))
                lists = [np.unique(hashes[x:z]).view(np.int64) for x, z in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(lists, pa.list_(pa.int64()))], ["item_id", "terms"])

    schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, terms array<long>"
    return items.select("item_id", "text").mapInArrow(run, schema)


def query_blocks(items: DataFrame, most: int = BLOCK_TERMS) -> Iterator[list[tuple]]:
    """The queries ``(item_id, term hashes)`` that have terms, in blocks of about ``most`` terms; one block at a time is held."""
    block, held = [], 0
    for row in stored(query_terms(items), "nra-queries").filter("size(terms) > 0").toLocalIterator():
        if block and held + len(row["terms"]) > most:
            yield block
            block, held = [], 0
        block.append((row["item_id"], np.array(row["terms"], dtype=np.int64).view(np.uint64)))
        held += len(row["terms"])
    if block:
        yield block


def document_terms(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, tf``, stored: each document's number of terms, its places in the sorted vocabulary and their counts."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = sent.value
        for batch in batches:
            for b in chunks(batch):
                hashes, bounds = term_hashes(b.column("text"))
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = np.flatnonzero(known[at] == hashes)
                doc = np.searchsorted(bounds, hit, side="right") - 1
                pair, tf = np.unique(doc * len(known) + at[hit], return_counts=True)
                begins = pa.array(np.searchsorted(pair, np.arange(b.num_rows + 1) * len(known)).astype(np.int32))
                terms = pa.ListArray.from_arrays(begins, pa.array((pair % len(known)).astype(np.int32)))
                counts = pa.ListArray.from_arrays(begins, pa.array(tf.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), terms, counts], ["doc_id", "n", "terms", "tf"])

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<long>")
    found = stored(made, "nra-documents")
    sent.unpersist()
    return found


def weights(found: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """The weight of each term of the vocabulary, N and L."""
    totals = found.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(size, dtype=np.int64)
    for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # one row per term of the block
        df[row["term"]] = row["count"]
    return np.floor(1000 * np.log((2 * totals["docs"] + 2) / (2 * df + 1))).astype(np.int64), totals["docs"], totals["terms"]


class Piece:
    """Documents of one piece, and the impact-sorted list of every term that they hold."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tf: np.ndarray, weight: np.ndarray, docs: int, total: int):
        m = 10 + (90 * n * docs) // max(total, 1)
        doc = np.repeat(np.arange(len(n)), sizes)
        impact = weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        some = impact > 0
        order = np.lexsort((doc[some], -impact[some], terms[some]))
        self.doc, self.impact = doc[some][order], impact[some][order]
        self.bounds = np.searchsorted(terms[some][order], np.arange(len(weight) + 1))
        self.size = len(n)

    def best(self, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of all that may be among the k best, if the k-th best score so far is ``floor``.

        These are all documents with a score above 0 of at least ``floor`` and
        of at least the k-th best of this piece, ties included.
        """
        begins, ends = self.bounds[terms], self.bounds[terms + 1]
        some = ends > begins
        begins, ends = begins[some], ends[some]
        at, step = begins.copy(), FIRST_READ
        lower = np.zeros(self.size, dtype=np.int64)
        needed = np.ones(len(at), dtype=bool)
        while True:
            for i in np.flatnonzero(needed & (at < ends)):
                read = slice(at[i], min(at[i] + step, ends[i]))
                lower[self.doc[read]] += self.impact[read]
                at[i] = read.stop
            step *= 4
            open_ = at < ends
            frontier = np.where(open_, self.impact[np.minimum(at, len(self.impact) - 1)], 0) if len(at) else at
            # What an unmet list may still add, less what lists that met the document cannot.
            ahead = np.full(self.size, frontier.sum(), dtype=np.int64)
            for i in np.flatnonzero(open_):
                ahead[self.doc[begins[i] : at[i]]] -= frontier[i]
            least = max(floor, 1)
            if self.size >= k:
                least = max(least, int(np.partition(lower, self.size - k)[self.size - k]))
            # Documents that were not met have the whole of the frontier ahead, and lower end 0.
            undecided = (ahead > 0) & (lower + ahead >= least)
            if not undecided.any():
                kept = np.flatnonzero(lower >= least)
                return kept, lower[kept]
            needed = np.array([undecided.sum() > undecided[self.doc[b:a]].sum() for b, a in zip(begins, at)], dtype=bool)


def _pieces(batches):
    """``ids, n, sizes, terms, tf`` of pieces of the documents that pass."""
    held, docs, postings = [], 0, 0

    def piece():
        ids = pa.chunked_array([x[0] for x in held])
        return ids, *(np.concatenate([x[i] for x in held]) for i in range(1, 5))

    for batch in batches:
        sizes = np.diff(batch.column("terms").offsets.to_numpy())
        begin = 0
        while begin < batch.num_rows:
            room = np.searchsorted(np.cumsum(sizes[begin:]), PIECE_POSTINGS - postings, side="right")
            end = min(batch.num_rows, begin + PIECE_DOCS - docs, begin + max(int(room), 0 if docs else 1))
            if end > begin:
                b = batch.slice(begin, end - begin)
                held.append((b.column("doc_id"), b.column("n").to_numpy(), sizes[begin:end], *(b.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("terms", "tf"))))
                docs, postings = docs + end - begin, postings + int(sizes[begin:end].sum())
            if end < batch.num_rows:
                yield piece()
                held, docs, postings = [], 0, 0
            begin = end
    if held:
        yield piece()


def _search_block(docs: DataFrame, block: list[tuple], k: int) -> DataFrame:
    """``query, doc_id, score``, stored: the best of each query of the block by its number in the block, k from each task."""
    spark = docs.sparkSession
    vocabulary = np.unique(np.concatenate([terms for _, terms in block]))
    queries = [np.searchsorted(vocabulary, terms) for _, terms in block]
    found = document_terms(docs, vocabulary)
    weight, n_docs, total = weights(found, len(vocabulary))
    sent = spark.sparkContext.broadcast((queries, weight))

    def run(batches):
        queries, weight = sent.value
        best = [[] for _ in queries]  # (-score, id is null, id), the k best of the task so far
        for ids, *columns in _pieces(batches):
            piece = Piece(*columns, weight, n_docs, total)
            for q, terms in enumerate(queries):
                floor = -best[q][-1][0] if len(best[q]) == k else 0
                at, scores = piece.best(terms, k, floor)
                if len(at):
                    new = [(-int(s), i is None, i or 0) for s, i in zip(scores, ids.take(pa.array(at)).to_pylist())]
                    best[q] = sorted(best[q] + new)[:k]
        rows = [(q, None if null else i, -s) for q, of in enumerate(best) for s, null, i in of]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64()))], ["query", "doc_id", "score"])

    some = found.filter("size(terms) > 0").select("doc_id", "n", "terms", "tf")
    hits = stored(some.mapInArrow(run, "query int, doc_id long, score long"), "nra-hits")
    sent.unpersist()
    return hits


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every row of ``items (item_id, text)``, all if fewer have a score."""
    spark, item_type = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for block in query_blocks(items, block_terms):
        hits = _search_block(docs, block, k).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(block)], f"query int, item_id {item_type}")
        ranked = hits.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
        out = out.union(ranked)
    return out
