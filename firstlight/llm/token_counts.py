"""Token counts by rank-synchronous array merging.

Distinct pre-tokens of a chunk are held as one ragged array of symbols. In
each round every sequence finds its lowest-rank pair and merges all places of
that pair at once; a sequence without a pair is done. A merged symbol takes
part only in pairs of higher rank, so this equals merging one place at a time.
Counts of pre-tokens already met are kept in a bounded table per process.

Null texts count as empty and have no tokens. Rows are counted one by one, so
repeated rows, null ids and extra columns do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstlight.llm import pretokens
from firstlight.llm.ragged import chunks, sums, utf8

MEMO_ENTRIES = 1 << 19
NO_RANK = np.iinfo(np.int64).max


class Merger:
    """Counts the symbols left in pre-tokens after all merges."""

    def __init__(self, path: str):
        self.keys, self.ranks, self.made, self.size = pretokens.merges(path)
        self.bytes = pretokens.byte_ids(path)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Surviving symbols of all words in a row, and the word of each."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        symbols = self.bytes[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        word = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        done_symbols, done_word = [], []
        while len(symbols) > 1:
            joined = word[1:] == word[:-1]
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(joined & (self.keys[at] == key), self.ranks[at], NO_RANK)
            rank = np.append(rank, NO_RANK)
            begins = np.flatnonzero(np.append(True, ~joined))
            lowest = np.minimum.reduceat(rank, begins)
            lengths = np.diff(np.append(begins, len(symbols)))
            active = np.repeat(lowest < NO_RANK, lengths)
            if not active.all():
                done_symbols.append(symbols[~active])
                done_word.append(word[~active])
                symbols, word, rank, at = symbols[active], word[active], rank[active], np.append(at, 0)[active]
                lengths, lowest = lengths[lowest < NO_RANK], lowest[lowest < NO_RANK]
                if not len(symbols):
                    break
            else:
                at = np.append(at, 0)
            hit = rank == np.repeat(lowest, lengths)
            # Of places that overlap, as in a run of one symbol, the first, third, ... are taken.
            place = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), place, 0))
            hit &= (place - run) % 2 == 0
            symbols = np.where(hit, self.made[at], symbols)
            keep = ~np.append(False, hit[:-1])
            symbols, word = symbols[keep], word[keep]
        done_symbols.append(symbols)
        done_word.append(word)
        word = np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return np.concatenate(done_symbols)[order], word[order]

    def counts(self, words: list[str]) -> np.ndarray:
        return np.bincount(self.merge(words)[1], minlength=len(words)).astype(np.int64) if words else np.zeros(0, dtype=np.int64)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row."""

    def run(batches):
        _, splitter = pretokens.load(tokenizer)
        special = pretokens.special_strings(tokenizer)
        merger, memo = Merger(tokenizer), {}
        for batch in batches:
            for b in chunks(batch):
                texts = [t or "" for t in b.column("text").to_pylist()]
                parts, owner, after = pretokens.pieces(texts, special)
                words, codes, bounds = splitter.distinct(parts)
                if len(memo) > MEMO_ENTRIES:
                    memo.clear()
                new = [w for w in words if w not in memo]
                memo.update(zip(new, merger.counts(new).tolist()))
                per_word = np.fromiter(map(memo.__getitem__, words), dtype=np.int64, count=len(words))
                per_part = sums(per_word[codes], bounds) + (np.array(after) >= 0)
                n_tokens = np.bincount(owner, weights=per_part, minlength=len(texts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(np.diff(utf8(b.column("text"))[1])), pa.array(n_tokens), pa.array(n_tokens > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
