"""Toxicity by noisy-channel restoration and significant word evidence.

Words that look disguised (symbols or digits inside letters or at their edges,
letters spelled out with blanks, letters repeated) are restored first: each
becomes a lattice of readings (a look-alike for a letter or, at an edge, for
nothing, a separator for nothing, a mask for any letter or nothing, a run for
one or two letters, a blank between spelled letters for nothing or for the end
of a word), and the Viterbi path under a character trigram model learned
from all texts is taken. Words and restored words give features: the
word and its beginnings of ``PREFIXES`` bytes, as 64-bit hashes.

A feature is evidence if it stands in toxic training documents more often than
chance allows, by a bound on the binomial tail. A word is as toxic as the
share of toxic documents among those with its known features, the longer the
feature the more it counts. A document's score is that of its most toxic word, whatever the document's length, so one toxic word
in a long text counts; without evidence it is half the share of toxic labels.

The model is learned from at most about ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``
labelled rows, chosen by a hash of the id; only their ids and labels are
collected. Where the two are sampled at different rates, shares, the base rate
and the calibration weigh each row by the inverse rate of its label, so scores
are those of the table's own share of toxic rows. Chance is judged by the rows
as drawn, against the base rate as drawn. Every row is scored, over its whole
text.

A null or empty text has no evidence. Documents with several labels count as
toxic if any says so; labels that are null or without a document are ignored.
Without toxic labels or without any evidence at all every score is 0.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstlight.llm.language_id import crc32_of_id
from firstlight.llm.ragged import LOWER, SPACE, chunks, hashes_of, mix, span_totals, utf8, words
from firstlight.llm.tables import small_batches, stored

SAMPLE_TOXIC = 1 << 15
SAMPLE_CLEAN = 1 << 16
PREFIXES = (4, 5, 6, 7)
LEAST_DOCS = 4
PRIOR_DOCS = 2.0
# Log odds are kept within this.
BOUND = 30.0
# Nats of evidence that a feature needs against chance.
SIGNIFICANCE = 16.0
# Below this share of toxic documents a feature says nothing against a text.
LEAST_SHARE = 0.5
CHUNK_ROWS = 4096

# What a look-alike may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
# Masks stand for any letter.
MASKS = "*#"
# Look-alikes that often stand at the edge of a word for themselves.
PUNCTUATION = "!(|+"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Costs of the channel, in nats.
SUBSTITUTED, DROPPED, MASKED, DOUBLED, STRAY = 1.0, 0.7, 1.5, 1.0, 9.0
# A letter typed twice for one, punctuation or another look-alike for nothing at an edge, a blank between spelled letters that ends a word.
TWICE, AT_EDGE, NUMBERED, BROKEN = 6.0, 1.5, 8.0, 1.0

_EDGE = np.zeros(256, dtype=bool)
_EDGE[[b for b in range(33, 127) if not chr(b).isalpha()]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[b for b in range(97, 123)]] = True
_LETTER[128:] = True
# Inside a word these are no letters.
_ODD = ~_LETTER & ~SPACE
# At an edge of a word these may be read as letters.
_LEADING = np.zeros(256, dtype=bool)
_LEADING[[ord(c) for c in LOOK_ALIKES if ord(c) < 128]] = True
_TRAILING = _LEADING.copy()
_TRAILING[[ord(c) for c in "!(|+269"]] = False


class CharModel:
    """Character trigrams over a-z, the word's edge and all other letters as one."""

    SIZE = 28  # 0: edge, 1-26: a-z, 27: other

    def __init__(self, counts: np.ndarray):
        total = counts.sum(axis=2, keepdims=True)
        lower = counts.sum(axis=0)
        bigram = (lower + 0.1) / (lower.sum(axis=1, keepdims=True) + 0.1 * self.SIZE)
        self.log = np.log((counts + 4 * bigram[None]) / (total + 4)).tolist()

    CODES = np.full(256, 27, dtype=np.int16)
    CODES[97:123] = np.arange(1, 27)

    def restore(self, word: str) -> str:
        """The most likely reading of a disguised word; spelled-out letters may give several, with blanks between them."""
        plain = [k for k, c in enumerate(word) if c.isalpha()] or [0, len(word) - 1]
        states = {(0, 0): (0.0, "")}
        i = 0
        while i < len(word):
            c, run = word[i], 1
            while i + run < len(word) and word[i + run] == c:
                run += 1
            i += run
            after: dict[tuple[int, int], tuple[float, str]] = {}
            if run == 1 and c.isalpha():
                # A letter stands for itself.
                k = ord(c) - 96 if "a" <= c <= "z" else 27
                for (a, b), (cost, text) in states.items():
                    total = cost - self.log[a][b][k]
                    if (b, k) not in after or total < after[b, k][0]:
                        after[b, k] = (total, text + c)
                states = after
                continue
            if c.isalpha():
                # Nobody types a letter three times by chance: one or two are meant.
                readings = [(c * run, 0.0)] + [(c, TWICE)] * (run == 2) if run < 3 else [(c, 0.0), (c + c, DOUBLED)]
            elif c == " ":
                readings = [("", DROPPED), (" ", BROKEN)]
            elif c in MASKS and 1 < run < 4:
                # One mask after the other, each for a letter or for nothing.
                i, readings = i - run + 1, [("", MASKED)] + [(x, MASKED) for x in LETTERS]
            else:
                edge = i - 1 < plain[0] or i - run > plain[-1]
                readings = [("", DROPPED if c not in LOOK_ALIKES else (AT_EDGE if c in PUNCTUATION else NUMBERED * run) if edge else STRAY)]
                for meant in LOOK_ALIKES.get(c, ""):
                    readings += [(meant * k, SUBSTITUTED * (1 if run < 3 else 2)) for k in ({run} if run < 3 else {1, 2})]
                if c in MASKS and run == 1:
                    readings += [(x, MASKED * 2) for x in LETTERS]
            for (a, b), (cost, text) in states.items():
                for meant, price in readings:
                    p, q, total = a, b, cost + price
                    for ch in meant:
                        k = ord(ch) - 96 if "a" <= ch <= "z" else 0 if ch == " " else 27
                        total -= self.log[p][q][k]
                        p, q = (q, k) if k else (0, 0)
                    if (p, q) not in after or total < after[p, q][0]:
                        after[p, q] = (total, text + meant)
            states = after
        return min((cost - self.log[a][b][0], text) for (a, b), (cost, text) in states.items())[1]


class Tokens:
    """Words of a chunk without punctuation at their edges, the plain ones as spans, the disguised ones as strings."""

    def __init__(self, column: pa.Array):
        data, offsets = utf8(column)
        self.data = data = LOWER[data]
        starts, ends, bounds = words(data, offsets)
        n_docs = len(offsets) - 1
        doc = np.repeat(np.arange(n_docs), np.diff(bounds))
        # Letters spelled out one by one, three or more in a row, look-alikes among them.
        lone = np.flatnonzero((ends - starts == 1) & (_LETTER | _LEADING)[data[starts]])
        spelled = []
        if len(lone):
            first = np.flatnonzero(np.append(True, (np.diff(lone) > 1) | (np.diff(doc[lone]) > 0)))
            count = np.diff(np.append(first, len(lone)))
            for f, c in zip(first[count >= 3].tolist(), count[count >= 3].tolist()):
                raw = bytes(data[starts[lone[f]] : ends[lone[f + c - 1]]])
                if _LETTER[list(raw)].sum() > 1:
                    spelled.append((int(doc[lone[f]]), b" ".join(raw.split()).decode("utf-8", "replace")))
        # Strip edges: positions of the first and last character that is no edge character, or may be a look-alike.
        open_ = np.flatnonzero(data[starts] == ord("("))
        closing = np.flatnonzero(data == ord(")"))
        starts[open_] += np.searchsorted(closing, ends[open_]) > np.searchsorted(closing, starts[open_])
        first, last, begin, end = starts.copy(), ends.copy(), starts.copy(), ends.copy()
        bare = np.zeros(len(starts), dtype=bool)
        edged = np.flatnonzero(_EDGE[data[starts]] | _EDGE[data[ends - 1]])
        if len(edged):
            near = lambda keep: np.append(np.flatnonzero(keep), len(data))
            inner, leading, trailing = near(~_EDGE[data]), near((~_EDGE | _LEADING)[data]), near((~_EDGE | _TRAILING)[data])
            s, e = starts[edged], ends[edged]
            behind = lambda kept: np.where(e > kept[0], kept[np.searchsorted(kept, e) - 1] + 1, 0)
            f, l = inner[np.searchsorted(inner, s)], behind(inner)
            b, t = leading[np.searchsorted(leading, s)], behind(trailing)
            some = (f < e) & (l > s)
            # Words of look-alikes alone, if they are of three or more that are not all the same.
            alone = np.flatnonzero(~some & (t - b >= 3))
            if len(alone):
                spans = np.stack([b[alone], t[alone]], axis=1).ravel()
                padded = np.append(data, 0)
                alone = alone[np.maximum.reduceat(padded, spans)[::2] > np.minimum.reduceat(padded, spans)[::2]]
            f[alone], l[alone] = b[alone], t[alone]
            some[alone] = True
            first[edged], last[edged], begin[edged], end[edged] = f, l, b, t
            bare[edged[alone]] = True
            keep = np.ones(len(starts), dtype=bool)
            keep[edged] = some
            first, last, begin, end, doc, bare = (x[keep] for x in (first, last, begin, end, doc, bare))
        disguised = bare | (begin < first) | (end > last)

        def mark(places: np.ndarray, behind: int) -> None:
            """Words that hold one of the places, so many bytes or more behind their first."""
            word = np.searchsorted(first, places, side="right") - 1
            word, places = word[word >= 0], places[word >= 0]
            disguised[word[(places < last[word]) & (places >= first[word] + behind)]] = True

        mark(np.flatnonzero(_ODD[data]), 0)
        same = np.flatnonzero((data[1:] == data[:-1]) & _LETTER[data[1:]]) + 1
        mark(same[data[same] < 128], 1)
        mark(same[1:][np.diff(same) == 1], 2)
        self.starts, self.ends, self.doc = first[~disguised], last[~disguised], doc[~disguised]
        self._totals = None
        self._disguised = begin[disguised], end[disguised], doc[disguised]
        self._spelled = spelled
        self.n_docs = n_docs

    def totals(self) -> np.ndarray:
        if self._totals is None:
            self._totals = span_totals(self.data)
        return self._totals

    @property
    def disguised(self) -> list[str]:
        words_of, which, _ = self.disguised_words()
        return [words_of[i] for i in which.tolist()]

    def disguised_words(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Different disguised words, which of them each one is, and the document of each."""
        begin, end, doc = self._disguised
        unique, at, first = _different(hashes_of(self.totals(), begin, end))
        raw = self.data.tobytes()
        found = [raw[a:b].decode("utf-8", "replace") for a, b in zip(begin[first].tolist(), end[first].tolist())]
        more = np.arange(len(self._spelled)) + len(found)
        return found + [w for _, w in self._spelled], np.concatenate([at, more]), np.concatenate([doc, np.array([d for d, _ in self._spelled], dtype=np.int64)])

    def trigrams(self) -> np.ndarray:
        """Counts of character trigrams in plain words."""
        size = CharModel.SIZE
        change = np.zeros(len(self.data) + 1, dtype=np.int8)
        change[self.starts] += 1
        change[self.ends] -= 1
        row = CharModel.CODES[self.data] * np.cumsum(change[:-1], dtype=np.int8)
        # Words are apart by at least one other byte, which counts as the edge.
        if len(row) < 2:
            return np.zeros((size, size, size), dtype=np.int64)
        b, c = row[:-1], row[1:]
        a = np.append(np.int16(0), row[:-2]) * (b > 0)
        found = np.bincount((a * np.int16(size) + b) * np.int16(size) + c, minlength=size**3)
        found[0] = 0
        return found.reshape(size, size, size)

    def features(self, restore) -> tuple[np.ndarray, np.ndarray]:
        """Feature hashes of each word, from the whole word to its shortest beginning, and the word's document."""
        keys, at, doc = self.distinct_features(restore)
        return keys[at], doc

    def distinct_features(self, restore) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature hashes of each different word, from the whole word to its shortest beginning, which of them each word is, and the word's document.

        A word too short for a beginning has its whole hash there.
        """
        words_of, which, owner = self.disguised_words()
        readings = [[x for x in restore(w).encode().split(b" ") if x] for w in words_of]
        restored = [x for several in readings for x in several]
        sizes = np.array([len(x) for x in readings], dtype=np.int64)
        behind = np.cumsum(sizes)
        # The readings of each disguised word, one after the other.
        n = sizes[which]
        some = np.repeat((behind - sizes)[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        extra = np.frombuffer(b"".join(restored), dtype=np.uint8)
        extra_ends = np.cumsum(np.array([len(x) for x in restored], dtype=np.int64))
        extra_starts = np.append(0, extra_ends)[:-1]
        sides = ((self.totals(), self.starts, self.ends), (span_totals(extra), extra_starts, extra_ends))
        _, at, first = _different(np.concatenate([hashes_of(*side) for side in sides]))
        plain = len(self.starts)
        sides = [(total, starts[of], ends[of]) for (total, starts, ends), of in zip(sides, (first[first < plain], first[first >= plain] - plain))]
        whole = np.concatenate([hashes_of(*side) for side in sides])
        length = np.concatenate([ends - starts for _, starts, ends in sides])
        keys = [whole]
        for k in sorted(PREFIXES, reverse=True):
            begun = np.concatenate([hashes_of(total, starts, np.minimum(starts + k, ends)) for total, starts, ends in sides])
            keys.append(np.where(length >= k, mix(begun + np.uint64(k)), whole))
        return np.stack(keys, axis=1), np.concatenate([at[:plain], at[plain:][some]]), np.concatenate([self.doc, np.repeat(owner, n)])

    def document_features(self, restore, of=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature hashes, and which of them each document has, each once; ``of`` tells which features of the different words count."""
        keys, at, doc = self.distinct_features(restore)
        ids, features = pd.factorize(keys.ravel())
        ids, size = ids.reshape(keys.shape), max(1, len(features))
        pair = _once(doc * max(1, len(keys)) + at)
        doc, word = pair // max(1, len(keys)), pair % max(1, len(keys))
        if of is None:
            pair = (doc[:, None] * size + ids[word]).ravel()
        else:
            counts = of(keys)
            some = counts.any(axis=1)[word]
            doc, word = doc[some], word[some]
            pair = (doc[:, None] * size + ids[word])[counts[word]]
        pair = _once(pair)
        return features, pair % size, pair // size


def _once(values: np.ndarray) -> np.ndarray:
    """The values in order, without repeats; several times faster here than ``unique``."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


def _different(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different hashes, which of them each one is, and where each stands first; in the order of their first places."""
    at, unique = pd.factorize(hashes)
    first = np.zeros(len(unique), dtype=np.int64)
    first[at[::-1]] = np.arange(len(at) - 1, -1, -1)
    return unique, at, first


class Restorer:
    """Remembers readings of words, up to a bound."""

    def __init__(self, model: CharModel, entries: int = 1 << 18):
        self.model, self.entries, self.memo = model, entries, {}

    def __call__(self, word: str) -> str:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= self.entries:
                self.memo.clear()
            found = self.memo[word] = self.model.restore(word)
        return found


_KNOWN: dict[bytes, Restorer] = {}


def restorer(chars: np.ndarray) -> Restorer:
    """The process's restorer of these trigram counts: what one task read, the next ones know."""
    key = hashlib.sha256(chars.tobytes()).digest()
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Restorer(CharModel(chars))
    return _KNOWN[key]


def _find(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each asked key among the sorted keys, -1 where it is missing."""
    if not len(keys):
        return np.full(asked.shape, -1)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, -1)


class Model:
    """Sorted feature keys with the toxic and all documents that have each, weighted by label.

    The features are the evidence and all longer ones under it, so a clean
    word is not judged by its beginning alone: from the shortest known feature
    of a word to the longest, each share is drawn towards the one before it as
    if that had been seen in ``PRIOR_DOCS`` documents.
    """

    def __init__(self, chars: np.ndarray, keys: np.ndarray, toxic: np.ndarray, n: np.ndarray, base: float):
        self.chars, self.keys, self.toxic, self.n, self.base = chars, keys, toxic, n, base
        self.slope, self.offset, self.without = 1.0, 0.0, 0.0

    def strongest(self, column: pa.Array, restore) -> np.ndarray:
        """Log odds of each text's most toxic word; ``-BOUND`` without evidence."""
        keys, at, owner = Tokens(column).distinct_features(restore)
        share = self.of_words(keys)
        odds = np.clip(np.log(np.maximum(share, 1e-300)) - np.log(np.maximum(1 - share, 1e-15)), -BOUND, BOUND)
        best = np.full(len(column), -BOUND)
        np.maximum.at(best, owner, odds[at])
        return best

    def calibrate(self, odds: np.ndarray, label: np.ndarray, n: np.ndarray) -> None:
        """Logistic fit of the label on the strongest word, which is the greatest of many and so looks stronger than it is."""
        none = odds <= -BOUND
        self.without = float((label * n)[none].sum() + 0.5) / (float(n[none].sum()) + 1.0)
        odds, label, n = odds[~none], label[~none], n[~none]
        w = np.array([1.0, 0.0])
        x = np.stack([odds / BOUND, np.ones(len(odds))], axis=1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (n * (label - p)) - 1e-3 * w
            bend = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            w = w + np.clip(np.linalg.solve(bend, slope), -5, 5)
        if w[0] > 0:
            self.slope, self.offset = w[0] / BOUND, w[1]

    def probability(self, odds: np.ndarray) -> np.ndarray:
        return np.where(odds <= -BOUND, self.without, 1 / (1 + np.exp(-np.clip(self.slope * odds + self.offset, -30, 30))))

    def of_words(self, keys: np.ndarray) -> np.ndarray:
        share, known = np.full(len(keys), self.base), np.zeros(len(keys), dtype=bool)
        if not len(self.keys):
            return np.zeros(len(keys))
        at = _find(self.keys, keys)
        for level in reversed(range(keys.shape[1])):
            place = at[:, level]
            # A word too short for a beginning has its whole hash there.
            here = (place >= 0) & ((level == 0) | (keys[:, level] != keys[:, 0]))
            share = np.where(here, (self.toxic[place] + PRIOR_DOCS * share) / (self.n[place] + PRIOR_DOCS), share)
            known |= here
        return np.where(known, share, 0.0)


def _sample(labelled: DataFrame, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray, tuple[float, float]]:
    """Ids and labels of at most about the given numbers of rows, by a hash of the id, sorted by id; the rates of clean and toxic rows."""
    n = {r[0]: r[1] for r in labelled.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity sample")), F.lit(1_000_000)) / 1_000_000
    rates = min(1.0, clean / max(1, n.get(0, 0))), min(1.0, toxic / max(1, n.get(1, 0)))
    share = F.when(F.col("toxic") == 1, rates[1]).otherwise(rates[0])
    rows = labelled.filter(draw < share).select("doc_id", "toxic").toPandas().sort_values("doc_id")
    return rows["doc_id"].to_numpy(dtype=np.int64), rows["toxic"].to_numpy(dtype=np.int64), rates


def _label(ids: np.ndarray, labels: np.ndarray, column: pa.Array) -> np.ndarray:
    """The label of each id, -1 where there is none."""
    asked = column.to_numpy(zero_copy_only=False)
    if not len(ids) or not len(asked):
        return np.full(len(asked), -1)
    known = ~np.isnan(asked.astype(np.float64))
    asked = np.where(known, asked, 0).astype(np.int64)
    at = np.minimum(np.searchsorted(ids, asked), len(ids) - 1)
    return np.where(known & (ids[at] == asked), labels[at], -1)


def fit(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Model:
    """Learns from documents with a label in ``labels (doc_id, toxic)``; rows with other ids are not read as labels."""
    with small_batches(docs.sparkSession):
        return _fit(docs, labels, toxic, clean)


def _fit(docs: DataFrame, labels: DataFrame, toxic: int, clean: int) -> Model:
    spark = docs.sparkSession
    given = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    given = given.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    *sample, rates = _sample(given, toxic, clean)
    sent = spark.sparkContext.broadcast(sample)
    texts = docs.select(F.col("doc_id").cast("long"), "text")

    def labelled(batches):
        for batch in batches:
            label = _label(*sent.value, batch.column("doc_id"))
            at = np.flatnonzero(label >= 0)
            if len(at):
                yield from chunks(batch.take(pa.array(at)).append_column("label", pa.array(label[at])), rows=CHUNK_ROWS)

    def trigrams(batches):
        total = np.zeros((CharModel.SIZE,) * 3, dtype=np.int64)
        for batch in batches:
            for b in chunks(batch, rows=CHUNK_ROWS):
                total += Tokens(b.column("text")).trigrams()
        at = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["gram", "n"])

    grams = texts.mapInArrow(trigrams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    chars = np.zeros(CharModel.SIZE**3)
    chars[grams["gram"].to_numpy(dtype=np.int64)] = grams["n"].to_numpy()
    chars = chars.reshape((CharModel.SIZE,) * 3)

    def toxic_features(batches):
        restore, held = restorer(chars), [(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))]
        for b in labelled(batches):
            b = b.filter(pa.array(b.column("label").to_numpy() == 1))
            features, which, _ = Tokens(b.column("text")).document_features(restore)
            held.append((features, np.bincount(which, minlength=len(features))))
        at, keys = pd.factorize(np.concatenate([k for k, _ in held]))
        n = np.bincount(at, weights=np.concatenate([n for _, n in held]), minlength=len(keys))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["feature", "n"])

    found = stored(
        texts.mapInArrow(toxic_features, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_DOCS),
        "toxicity-features",
    )
    pdf = found.toPandas().sort_values("feature")  # bounded by the sample
    keys = pdf["feature"].to_numpy(dtype=np.int64).view(np.uint64)
    in_toxic = pdf["n"].to_numpy(dtype=np.int64)
    order = np.argsort(keys)
    keys, in_toxic = keys[order], in_toxic[order]
    asked = spark.sparkContext.broadcast(keys)

    def clean_counts(batches):
        restore, known = restorer(chars), asked.value
        total = np.zeros(len(known) + 2, dtype=np.int64)
        for b in labelled(batches):
            total[-1] += int((b.column("label").to_numpy() == 1).sum())
            b = b.filter(pa.array(b.column("label").to_numpy() == 0))
            total[-2] += b.num_rows
            features, which, _ = Tokens(b.column("text")).document_features(restore)
            at = _find(known, features)
            total[:-2][at[at >= 0]] += np.bincount(which, minlength=len(features))[at >= 0]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    pdf = texts.mapInArrow(clean_counts, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(keys) + 2, dtype=np.int64)
    counts[pdf["at"].to_numpy(dtype=np.int64)] = pdf["n"].to_numpy()
    in_clean, n_clean, n_toxic = counts[:-2], int(counts[-2]), int(counts[-1])
    if not n_toxic:
        return Model(chars, keys[:0], in_toxic[:0], in_toxic[:0], 0.0)
    # Weights of clean and toxic rows; over the sample they are 1 on average, so that PRIOR_DOCS stays a number of rows.
    weight = np.array([1 / rates[0], 1 / rates[1]])
    weight *= (n_toxic + n_clean) / (weight @ [n_clean, n_toxic])
    base = weight[1] * n_toxic / (n_toxic + n_clean)
    n = in_toxic + in_clean
    share = weight[1] * in_toxic / np.maximum(weight[1] * in_toxic + weight[0] * in_clean, 1e-300)
    # Chernoff bound of the binomial tail: n times the divergence of the share from the base rate, both as drawn.
    p, q = min(max(n_toxic / (n_toxic + n_clean), 1e-9), 1 - 1e-9), np.clip(in_toxic / np.maximum(n, 1), 1e-12, 1 - 1e-12)
    evidence = n * (q * np.log(q / p) + (1 - q) * np.log((1 - q) / (1 - p)))
    strong = np.sort(keys[(share >= LEAST_SHARE) & (share > base) & (evidence >= SIGNIFICANCE)])
    under = spark.sparkContext.broadcast(strong)

    def with_evidence(keys):
        """Evidence and what is longer than it in the same word; shorter features are not counted in full here."""
        hit = _find(under.value, keys) >= 0
        return np.logical_or.accumulate(hit[:, ::-1], axis=1)[:, ::-1]

    def below(batches):
        restore = restorer(chars)
        held = [(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))]
        for b in labelled(batches):
            features, which, owner = Tokens(b.column("text")).document_features(restore, with_evidence)
            held.append((features[which], b.column("label").to_numpy()[owner]))
        found = np.concatenate([k for k, _ in held])
        unique, at = np.unique(found, return_inverse=True)
        toxic_n = np.bincount(at, weights=np.concatenate([x for _, x in held]), minlength=len(unique)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(unique.view(np.int64)), pa.array(toxic_n), pa.array(np.bincount(at, minlength=len(unique)))], ["feature", "toxic", "n"]
        )

    known = texts.mapInArrow(below, "feature long, toxic long, n long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    pdf = known.toPandas()  # bounded by the sample
    keys = pdf["feature"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    in_toxic, n = (pdf[c].to_numpy(dtype=np.float64)[order] for c in ("toxic", "n"))
    model = Model(chars, keys[order], weight[1] * in_toxic, weight[1] * in_toxic + weight[0] * (n - in_toxic), base)
    raw = spark.sparkContext.broadcast(model)

    def strongest(batches):
        restore = restorer(chars)
        for b in labelled(batches):
            odds = np.round(raw.value.strongest(b.column("text"), restore) * 8) / 8
            yield pa.RecordBatch.from_arrays([pa.array(odds), b.column("label")], ["odds", "label"])

    pdf = texts.mapInArrow(strongest, "odds double, label long").groupBy("odds", "label").agg(F.count("*").alias("n")).toPandas()
    label = pdf["label"].to_numpy(dtype=np.int64)
    model.calibrate(pdf["odds"].to_numpy(dtype=np.float64), label, weight[label] * pdf["n"].to_numpy(dtype=np.float64))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        restore = restorer(m.chars)
        for batch in batches:
            for b in chunks(batch, rows=CHUNK_ROWS):
                best = m.probability(m.strongest(b.column("text"), restore)) if len(m.keys) else np.zeros(b.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(best), pa.array((best >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        restore = restorer(m.chars)
        for batch in batches:
            for b in chunks(batch, rows=CHUNK_ROWS):
                keep = m.probability(m.strongest(b.column("text"), restore)) < 0.5 if len(m.keys) else np.ones(b.num_rows, dtype=bool)
                yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def held_out(docs: DataFrame):
    """Whether a row's label may not be learned: crc32 of the id modulo 5 is 0."""
    return F.coalesce(crc32_of_id() % 5 == 0, F.lit(False))


def score_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from rows that are not held out and scores all: ``doc_id, held_out, score, predicted``."""
    model = fit(docs, labels.filter(~held_out(labels)))
    return score(docs, model).select("doc_id", held_out(docs).alias("held_out"), "score", "predicted")
