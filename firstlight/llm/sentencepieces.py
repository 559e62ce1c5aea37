"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

A text is escaped as the model does it (a blank in front, blanks as U+2581)
and cut before each blank run; no piece of a merge-type model crosses such a
cut, so the parts are encoded one by one. Encoding takes the best candidate
merge from the agenda, by score and then from the left. A candidate whose
keyed hash is below the dropout is skipped. The hash's key is made of the
seed, the document's id and the number of the part in its text; a candidate is
named by its place in the part. One seed gives one segmentation, on any
cluster and in any retry.

Equal parts share work only as far as their keys agree. The merges of a word
are found without dropout first; each occurrence holds them against its own
key. Occurrences that drop the same candidate go on together from there, so
every part gets what it would get if it were encoded alone.

Characters outside the vocabulary become byte pieces, and so does U+2581
itself, which makes decoding give back every text exactly.

Short parts of a chunk are encoded together as ragged arrays, one merge per
part and round; parts longer than ``AGENDA_FROM`` characters have an agenda of
their own.

A null text is empty and has no pieces. A null ``doc_id`` keys like 0; rows of
one id and text get the same pieces. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firstlight.llm.ragged import chunks, mix, point_hashes

DROPOUT = 0.1
SEED = 20
AGENDA_FROM = 64
# Rounds in which occurrences of a word are told apart by what they drop, before the rest is encoded one by one.
SHARED_ROUNDS = 12
CHUNK_BYTES = 1 << 20
BLANK = "▁"
PART = re.compile(f"{BLANK}*[^{BLANK}]*")
# A U+2581 of the text itself, kept apart from blanks until bytes are made.
LITERAL = "\ud800"


class Pieces:
    """The model's pieces, scores, and the merge of each pair of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.id = {self.text[i]: i for i in plain}
        self.score = np.full(n, -np.inf)
        self.score[plain] = [model.get_score(i) for i in plain]
        self.byte = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int64)
        self.raw = [t.replace(BLANK, " ").encode() for t in self.text]
        for b, p in enumerate(self.byte.tolist()):
            self.raw[p] = bytes([b])
        self.size = n
        pairs = {}
        for i in plain:
            t = self.text[i]
            for k in range(1, len(t)):
                a, b = self.id.get(t[:k]), self.id.get(t[k:])
                if a is not None and b is not None:
                    pairs[a * n + b] = i
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.made = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.merge_of = pairs
        if any(BLANK in t.lstrip(BLANK) for t in self.id):
            raise ValueError("a piece goes on after a blank, so texts cannot be cut at blanks")

    def symbols(self, part: str) -> list[int]:
        """A piece per character; characters without one are below zero."""
        return [self.id.get(c, -ord(c) - 1) for c in part]

    def with_bytes(self, symbol: int) -> list[int]:
        if symbol >= 0:
            return [symbol]
        c = chr(-symbol - 1)
        return self.byte[list((BLANK if c == LITERAL else c).encode("utf-8", "surrogatepass"))].tolist()


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def escape(text: str) -> str:
    """The text as the model segments it; empty stays empty."""
    return (BLANK + text.replace(BLANK, LITERAL).replace(" ", BLANK)) if text else ""


def parts(escaped: str) -> list[str]:
    return [p for p in PART.findall(escaped) if p]


def _threshold(dropout: float) -> np.uint64:
    return np.uint64(min(int(dropout * 2.0**64), 2**64 - 1))


def candidate_hash(key, begin, middle, end) -> np.ndarray:
    """Keyed hash of the candidate that joins [begin, middle) and [middle, end) of a part."""
    u = lambda x: np.asarray(x, dtype=np.uint64)
    place = u(begin) << np.uint64(42) ^ u(middle) << np.uint64(21) ^ u(end)
    return mix(np.atleast_1d(u(key) ^ mix(np.atleast_1d(place + np.uint64(1)))))


def encode_by_agenda(pieces: Pieces, part: str, key: int, dropout: float) -> list[int]:
    """Symbols of one part, one candidate of the agenda after the other."""
    symbols, n = pieces.symbols(part), len(part)
    begin, end = list(range(n)), list(range(1, n + 1))
    before, after = list(range(-1, n - 1)), list(range(1, n)) + [-1]
    alive, agenda, limit = [True] * n, [], _threshold(dropout)

    def offer(i: int, j: int) -> None:
        made = pieces.merge_of.get(symbols[i] * pieces.size + symbols[j]) if symbols[i] >= 0 and symbols[j] >= 0 else None
        if made is not None:
            heapq.heappush(agenda, (-pieces.score[made], begin[i], i, j, end[j], made))

    for i in range(n - 1):
        offer(i, i + 1)
    while agenda:
        _, _, i, j, stop, made = heapq.heappop(agenda)
        if not (alive[i] and alive[j]) or after[i] != j or end[j] != stop or pieces.merge_of.get(symbols[i] * pieces.size + symbols[j]) != made:
            continue
        if dropout and candidate_hash(key, begin[i], begin[j], stop)[0] < limit:
            continue
        symbols[i], end[i], alive[j] = made, end[j], False
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
            offer(i, after[j])
        if before[i] >= 0:
            offer(before[i], i)
    return [s for s, a in zip(symbols, alive) if a]


def encode_together(pieces: Pieces, texts: list[str], keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of many parts in a row and the part of each: every round takes the best candidate of each part."""
    limit = _threshold(dropout)
    return _merge_together(pieces, texts, (lambda part, *place: candidate_hash(keys[part], *place) < limit) if dropout else None)


def _merge_together(pieces: Pieces, texts: list[str], dropped=None, taken: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """As ``encode_together``, without the candidates that ``dropped(part, begin, middle, end)`` tells; ``taken`` gets the merges of each round."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    distinct, at = np.unique(points, return_inverse=True)
    symbol = np.array([pieces.id.get(chr(c), -int(c) - 1) for c in distinct.tolist()], dtype=np.int64)[at]
    part = np.repeat(np.arange(len(texts)), lengths)
    begin = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    end = begin + 1
    done_symbol, done_part = [], []

    def offers(i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and piece of the candidate that joins symbols i and i + 1; minus infinity where there is none."""
        key = symbol[i] * pieces.size + symbol[i + 1]
        where = np.minimum(np.searchsorted(pieces.pair_keys, key), len(pieces.pair_keys) - 1)
        near = (part[i] == part[i + 1]) & (symbol[i] >= 0) & (symbol[i + 1] >= 0) & (pieces.pair_keys[where] == key)
        if dropped is not None:
            some = np.flatnonzero(near)
            j = i[some]
            near[some] = ~dropped(part[j], begin[j], begin[j + 1], end[j + 1])
        made = pieces.made[where]
        return np.where(near, pieces.score[made], -np.inf), made

    score, made = np.full(len(symbol), -np.inf), np.zeros(len(symbol), dtype=np.int64)
    if len(symbol):
        score[:-1], made[:-1] = offers(np.arange(len(symbol) - 1))
    while len(symbol):
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        sizes = np.diff(np.append(first, len(symbol)))
        best = np.maximum.reduceat(score, first)
        active = best > -np.inf
        idle = np.repeat(~active, sizes)
        done_symbol.append(symbol[idle])
        done_part.append(part[idle])
        # Of equal scores in a part the leftmost goes first.
        i = np.flatnonzero((score == np.repeat(best, sizes)) & ~idle)
        i = i[np.append(True, part[i[1:]] != part[i[:-1]])] if len(i) else i
        if taken is not None:
            taken.append(np.stack([part[i], begin[i], begin[i + 1], end[i + 1]]))
        symbol[i], end[i] = made[i], end[i + 1]
        keep = ~idle
        keep[i + 1] = False
        at = np.cumsum(keep)[i] - 1
        symbol, part, begin, end, score, made = (x[keep] for x in (symbol, part, begin, end, score, made))
        # Only the merged symbols have new neighbours.
        score[at] = -np.inf
        left = at[at > 0] - 1
        score[left] = -np.inf
        for changed in (left, at[at < len(symbol) - 1]):
            score[changed], made[changed] = offers(changed)
    if not done_symbol:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    part = np.concatenate(done_part)
    order = np.argsort(part, kind="stable")
    return np.concatenate(done_symbol)[order], part[order]


def encode_occurrences(pieces: Pieces, words: list[str], word: np.ndarray, keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``encode_together`` of ``words[word]`` with ``keys``: symbols of the distinct results, the result of each, and the result of each occurrence.

    A round has states, each a word and the candidates dropped so far. An
    occurrence whose key drops none of its state's merges has the state's
    result; the others go to the state that also drops their first such merge.
    """
    limit, result = _threshold(dropout), np.zeros(len(word), dtype=np.int64)
    symbols, owners, made = [], [], 0
    left, state, of_state = np.arange(len(word)), word, np.arange(len(words))
    banned = np.zeros((4, 0), dtype=np.int64)  # state, begin, middle, end

    def add(found: np.ndarray, owner: np.ndarray, n: int) -> None:
        nonlocal made
        symbols.append(found)
        owners.append(owner + made)
        made += n

    for _ in range(SHARED_ROUNDS):
        if 2 * len(of_state) > len(left):
            break
        # Texts are short, so a place fits into 21 bits.
        named = lambda part, begin, middle, end: ((part * 128 + begin) * 128 + middle) * 128 + end
        skipped = np.sort(named(*banned))

        def dropped(*candidate, skipped=skipped):
            asked = named(*candidate)
            return skipped[np.minimum(np.searchsorted(skipped, asked), len(skipped) - 1)] == asked

        taken: list[np.ndarray] = []
        found = _merge_together(pieces, [words[i] for i in of_state.tolist()], dropped if len(skipped) else None, taken)
        merges = np.concatenate([np.zeros((4, 0), dtype=np.int64), *taken], axis=1)
        merges = merges[:, np.argsort(merges[0], kind="stable")]
        begins = np.searchsorted(merges[0], np.arange(len(of_state) + 1))
        n = np.diff(begins)[state]
        occurrence = np.repeat(np.arange(len(left)), n)
        at = np.arange(len(occurrence)) + np.repeat(begins[state] - (np.cumsum(n) - n), n)
        out = np.flatnonzero(candidate_hash(keys[left][occurrence], *merges[1:, at]) < limit)
        who, first = np.unique(occurrence[out], return_index=True)
        result[left] = made + state
        add(*found, len(of_state))
        # A merge belongs to one state, so it names the state that drops it too.
        told, state = np.unique(at[out[first]], return_inverse=True)
        old = merges[0, told]
        order = np.argsort(banned[0], kind="stable")
        banned = banned[:, order]
        lo, hi = np.searchsorted(banned[0], old), np.searchsorted(banned[0], old, side="right")
        kept = np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo) + np.arange((hi - lo).sum())
        handed = np.concatenate([np.repeat(np.arange(len(told)), hi - lo)[None], banned[1:, kept]])
        banned = np.concatenate([handed, np.concatenate([np.arange(len(told))[None], merges[1:, told]])], axis=1)
        left, of_state = left[who], of_state[old]
        if not len(left):
            break
    if len(left):
        result[left] = made + np.arange(len(left))
        add(*encode_together(pieces, [words[i] for i in word[left].tolist()], keys[left], dropout), len(left))
    return np.concatenate([np.zeros(0, dtype=np.int64), *symbols]), np.concatenate([np.zeros(0, dtype=np.int64), *owners]), result


def part_keys(seed: int, doc_keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The key of each part, by the seed, the document and the part's number."""
    own = mix(np.array([seed], dtype=np.int64).view(np.uint64))
    return mix(mix(mix(doc_keys + own) ^ numbers.astype(np.uint64)) + mix(own))


class Encoder:
    """Encodes texts; equal parts of a call are found by a 64-bit hash of their code points."""

    def __init__(self, pieces: Pieces, dropout: float = DROPOUT, seed: int = SEED):
        self.pieces, self.dropout, self.seed = pieces, dropout, seed

    def _encode(self, words: list[str], word: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all distinct results in a row, the number of each, and the result of each occurrence of a word."""
        sizes = np.array([len(w) for w in words])
        short = np.flatnonzero(sizes <= AGENDA_FROM)
        place = np.cumsum(sizes <= AGENDA_FROM) - 1
        result = np.zeros(len(word), dtype=np.int64)
        here = np.flatnonzero(sizes[word] <= AGENDA_FROM)
        few = [words[i] for i in short.tolist()]
        if self.dropout:
            symbols, owner, result[here] = encode_occurrences(self.pieces, few, place[word[here]], keys[here], self.dropout)
        else:
            (symbols, owner), result[here] = encode_together(self.pieces, few, keys, 0.0), place[word[here]]
        n = int(owner.max(initial=-1)) + 1
        long, known = [], {}
        for o in np.flatnonzero(sizes[word] > AGENDA_FROM).tolist():
            named = (int(word[o]), int(keys[o]) if self.dropout else 0)
            if named not in known:
                known[named] = n + len(long)
                long.append(np.array(encode_by_agenda(self.pieces, words[word[o]], named[1], self.dropout), dtype=np.int64))
            result[o] = known[named]
        if long:
            symbols = np.concatenate([symbols, *long])
            owner = np.concatenate([owner, np.repeat(n + np.arange(len(long)), [len(x) for x in long])])
        n += len(long)
        order = np.argsort(owner, kind="stable")
        symbols, owner = symbols[order], owner[order]
        # Characters without a piece become their bytes.
        odd = np.flatnonzero(symbols < 0)
        if len(odd):
            spread = [self.pieces.with_bytes(int(s)) for s in symbols[odd]]
            times = np.ones(len(symbols), dtype=np.int64)
            times[odd] = [len(x) for x in spread]
            wide = np.repeat(symbols, times)
            wide[wide < 0] = np.concatenate(spread)
            symbols, owner = wide, np.repeat(owner, times)
        return symbols.astype(np.int32), np.bincount(owner, minlength=n), result

    def __call__(self, texts: list[str], keys_of_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the number of each text's."""
        escaped = [escape(t) for t in texts]
        joined = "".join(escaped)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        offsets = np.append(0, np.cumsum([len(t) for t in escaped], dtype=np.int64))
        if not len(points):
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        # A part begins with a run of blanks; every text begins with a blank.
        blank = points == ord(BLANK)
        begins = blank & ~np.append(False, blank[:-1])
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(points))
        bounds = np.searchsorted(starts, offsets)
        per_text = np.diff(bounds)
        numbers = np.arange(len(starts)) - np.repeat(bounds[:-1], per_text)
        keys = part_keys(self.seed, np.repeat(keys_of_docs, per_text), numbers) if self.dropout else np.zeros(len(starts), dtype=np.uint64)
        word, unique = pd.factorize(point_hashes(points, starts, ends))
        seen = np.zeros(len(unique), dtype=np.int64)
        seen[word[::-1]] = np.arange(len(word) - 1, -1, -1)
        found, count, both = self._encode([joined[a:b] for a, b in zip(starts[seen].tolist(), ends[seen].tolist())], word, keys)
        begin, size = (np.cumsum(count) - count)[both], count[both]
        out_at = np.append(0, np.cumsum(size))
        ids = found[np.repeat(begin - out_at[:-1], size) + np.arange(out_at[-1])]
        return ids, out_at[bounds[1:]] - out_at[bounds[:-1]]


def decode_ids(pieces: Pieces, ids: list[int]) -> str:
    """The text of an encoding: all pieces as bytes, one after the other, without the blank in front."""
    return b"".join(map(pieces.raw.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def doc_keys(column: pa.Array) -> np.ndarray:
    return mix(np.array([x or 0 for x in column.to_pylist()], dtype=np.int64).view(np.uint64))


def _chunks_encoded(batches, model: str, dropout: float, seed: int):
    """Slices of the batches with their ids in a row and where each row's begin."""
    encoder = Encoder(load(model), dropout, seed)
    for batch in batches:
        for b in chunks(batch, limit=CHUNK_BYTES):
            ids, n = encoder([t or "" for t in b.column("text").to_pylist()], doc_keys(b.column("doc_id")))
            yield b, ids, np.append(0, np.cumsum(n))


def _decoded(model: str, ids: np.ndarray, offsets: np.ndarray):
    pieces = load(model)
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield decode_ids(pieces, ids[begin:end].tolist())


def encode(
    docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED, keep: list[str] | None = None, checked: bool = False
) -> DataFrame:
    """``doc_id, text, ids`` and the columns in ``keep``: the piece ids of every row, with its text.

    ``checked`` adds ``lossless``: whether decoding the ids gives the text. A
    kept column with the name of one of these comes back as ``kept_<name>``.
    """
    own = {"doc_id", "text", "ids", "lossless"}
    rows = docs.select(F.col("doc_id").cast("long"), "text", *[F.col(c).alias(f"kept_{c}" if c.lower() in own else c) for c in keep or []])

    def run(batches):
        for b, ids, offsets in _chunks_encoded(batches, model, dropout, seed):
            texts = b.column("text")
            out = b.append_column("ids", pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)))
            if checked:
                same = [(t.as_py() or "") == d for t, d in zip(texts, _decoded(model, ids, offsets))]
                out = out.append_column("lossless", pa.array(same, pa.bool_()))
            yield out

    fields = [*rows.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return rows.mapInArrow(run, T.StructType(fields + [T.StructField("lossless", T.BooleanType())] * checked))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``."""

    def run(batches):
        pieces = load(model)
        for b in batches:
            texts = [decode_ids(pieces, x) for x in b.column("ids").to_pylist()]
            yield b.append_column("decoded", pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def round_trip(docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, ids_crc32, text_sha256, lossless`` of every row; the bytes are those of the decoded text."""

    def run(batches):
        for b, ids, offsets in _chunks_encoded(batches, model, dropout, seed):
            flat, columns = ids.astype("<u4"), [[], [], [], []]
            for t, d, p, q in zip(b.column("text"), _decoded(model, ids, offsets), offsets[:-1].tolist(), offsets[1:].tolist()):
                raw = d.encode("utf-8", "surrogatepass")
                for column, value in zip(columns, (len(raw), zlib.crc32(flat[p:q].tobytes()), hashlib.sha256(raw).hexdigest(), (t.as_py() or "") == d)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "ids_crc32", "text_sha256", "lossless"],
            )

    schema = "doc_id long, n_bytes long, n_tokens long, ids_crc32 long, text_sha256 string, lossless boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
