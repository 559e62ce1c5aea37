"""Language identification: first the family, then one-versus-one linear SVMs inside it.

A text is its byte trigrams over lower-cased letters, hashed into ``FEATURES``
counts, square-rooted and scaled to length one. Families are told apart by
one-versus-rest linear SVMs; languages of the chosen family by one linear SVM
per pair, which vote. Languages without a listed family are families of their
own.

The models are fitted on at most about ``SAMPLE_PER_LANGUAGE`` labelled rows
of each language, chosen by a hash of the id. Every row is scored, over its
whole text.

A text that is null or has no letter gets ``und`` with score 0, and so does
every text when there is no labelled row. Repeated rows get equal results;
other columns than ``doc_id``, ``text`` and, for learning, ``lang`` are
ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstlight.llm.ragged import LOWER, chunks, utf8

FEATURES = 1 << 12
SAMPLE_PER_LANGUAGE = 1500
CHUNK_ROWS = 512
UNDETERMINED = "und"

# Families of languages, by ISO 639 codes.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ca ro gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tt tk",
    "indo-aryan": "hi ur bn pa gu mr ne",
    "iranian": "fa ku ps tg",
    "semitic": "ar he mt am",
    "sinitic": "zh yue wuu",
    "austronesian": "id ms tl jv mi",
    "dravidian": "ta te kn ml",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def family(language: str) -> str:
    return FAMILY_OF.get(language.lower().split("-")[0], language)


def _letters() -> np.ndarray:
    """Byte values as features see them: letters and bytes of other characters stay, all else is a blank."""
    table = LOWER.copy()
    for b in range(128):
        if not chr(b).isalpha():
            table[b] = 32
    return table


LETTERS = _letters()


def features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text, of length one or zero."""
    data, offsets = utf8(column)
    data = LETTERS[data].astype(np.uint32)
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    if len(data) < 3:
        return np.zeros((n, FEATURES), dtype=np.float32)
    gram = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    at = gram * np.uint32(2654435761) >> np.uint32(32 - FEATURES.bit_length() + 1)
    ok = (row[:-2] == row[2:]) & ~((data[1:-1] == 32) & ((data[:-2] == 32) | (data[2:] == 32)))
    counts = np.bincount(row[:-2][ok] * FEATURES + at[ok], minlength=n * FEATURES).reshape(n, FEATURES)
    x = np.sqrt(counts).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 300) -> np.ndarray:
    """Weights and offset of a linear SVM with squared hinge loss; both classes weigh the same. Accelerated gradient steps."""
    side = np.where(y, 1.0, -1.0).astype(np.float32)
    weight = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum())).astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    w = np.zeros(x.shape[1], dtype=np.float32)
    ahead, pace = w, 1.0
    for _ in range(rounds):
        gap = np.maximum(0, 1 - side * (x @ ahead))
        step = ahead - 0.25 * (penalty * ahead - 2 * (weight * side * gap) @ x)
        next_pace = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead = step + (pace - 1) / next_pace * (step - w)
        w, pace = step, next_pace
    return w


class Model:
    """Family weights, and for each family the weights of its pairs of languages."""

    def __init__(self, x: np.ndarray, languages: list[str]):
        names = np.array(languages)
        kin = np.array([family(n) for n in languages])
        self.families = sorted(set(kin))
        self.by_family = np.stack([fit_svm(x, kin == f) for f in self.families]) if len(self.families) > 1 else None
        self.members = {f: sorted(set(names[kin == f])) for f in self.families}
        self.pairs = {
            f: [(a, b, fit_svm(x[(names == a) | (names == b)], names[(names == a) | (names == b)] == a)) for a, b in combinations(m, 2)]
            for f, m in self.members.items()
        }

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row."""
        squash = lambda m: 1 / (1 + np.exp(-4 * m))
        if self.by_family is None:
            pick, sure = np.zeros(len(x), dtype=np.int64), np.ones(len(x))
        else:
            margins = x @ self.by_family[:, :-1].T + self.by_family[:, -1]
            pick, sure = margins.argmax(axis=1), squash(margins.max(axis=1).astype(np.float64))
        out, score = np.empty(len(x), dtype=object), np.zeros(len(x))
        for k, f in enumerate(self.families):
            rows = np.flatnonzero(pick == k)
            members = self.members[f]
            votes, lead = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for a, b, w in self.pairs[f]:
                margin = (x[rows] @ w[:-1] + w[-1]).astype(np.float64)
                for name, m in ((a, margin), (b, -margin)):
                    i = members.index(name)
                    votes[:, i] += m > 0
                    lead[:, i] += squash(m)
            # Votes decide; the mean of the squashed margins breaks ties.
            won = (votes + lead / (len(members) + 1)).argmax(axis=1)
            out[rows] = np.array(members, dtype=object)[won]
            inside = lead[np.arange(len(rows)), won] / max(1, len(members) - 1) if len(members) > 1 else 1.0
            score[rows] = sure[rows] * inside
        return out, score


def fit(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Fits on rows ``doc_id, text, lang``; about ``per_language`` of each language, by a hash of the id."""
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1_000_000)) / 1_000_000
    sample = labelled.filter(draw < share[F.col("lang")]).select("text", "lang")

    def run(batches):
        for batch in batches:
            for b in chunks(batch, rows=CHUNK_ROWS):
                x = features(b.column("text")).astype(np.float16)
                yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"])

    rows = sample.mapInArrow(run, "lang string, x binary").collect()  # bounded by per_language
    if not rows:
        return None
    rows.sort()
    x = np.stack([np.frombuffer(r["x"], dtype=np.float16) for r in rows]).astype(np.float32)
    return Model(x, [r["lang"] for r in rows])


def crc32_of_id(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = sent.value
        for batch in batches:
            for b in chunks(batch, rows=CHUNK_ROWS):
                letters = np.array([has_letter(t) for t in b.column("text").to_pylist()], dtype=bool)
                if known is None:
                    names, score = np.full(b.num_rows, UNDETERMINED, dtype=object), np.zeros(b.num_rows)
                else:
                    names, score = known.predict(features(b.column("text")))
                    names[~letters], score[~letters] = UNDETERMINED, 0.0
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"]
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify_held_out(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Learns from rows whose crc32 of the id modulo 4 is not 2 and scores all rows: ``doc_id, held_out, lang_pred, score``."""
    held = F.coalesce(crc32_of_id() % 4 == 2, F.lit(False))
    model = fit(docs.filter(~held), per_language)
    return identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
