"""Byte-level BPE: splitting texts into pre-tokens with numpy, and the parts of a tokenizer file.

The split is that of the file's own pre-tokenizer (contractions, letters,
numbers, other characters, white space), computed on arrays of code points.
The class of a code point is asked from the library once per process.

Equal pre-tokens are found by a 64-bit hash of their code points.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd

from firstlight.llm.ragged import mix

SPACE, LETTER, NUMBER, OTHER, UNKNOWN = 0, 1, 2, 3, 9
CODE_POINTS = 0x110000

# Fixed values of the pre-tokenizer: what may follow an apostrophe.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")


class Splitter:
    """Splits texts as the tokenizer's pre-tokenizer does."""

    def __init__(self, tokenizer):
        self._pre = tokenizer.pre_tokenizer
        self._class = np.full(CODE_POINTS, UNKNOWN, dtype=np.uint8)
        self._hash = mix(np.arange(1, CODE_POINTS + 1, dtype=np.uint64))
        self._power = np.zeros((2, 0), dtype=np.uint64)
        self._classify(np.arange(128))

    def _classify(self, points: np.ndarray) -> None:
        for p in points:
            c = chr(int(p))
            self._class[p] = next(
                (k for k, before in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self._pre.pre_tokenize_str(before + c)) == 1),
                SPACE,
            )

    def starts(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin, over texts that begin at ``offsets`` (the last is the end)."""
        n = len(points)
        kind = self._class[points]
        if (kind == UNKNOWN).any():
            self._classify(np.unique(points[kind == UNKNOWN]))
            kind = self._class[points]
        first = np.zeros(n + 1, dtype=bool)
        first[offsets] = True
        first = first[:n]
        start = first.copy()
        start[1:] |= kind[1:] != kind[:-1]
        # The last blank before a word belongs to it; other white space there stands alone.
        after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:]) + 1
        start[after - 1] = True
        start[after] = points[after - 1] != 32
        # An apostrophe that begins a pre-token takes certain endings with it.
        q = np.flatnonzero((points == 39) & start)
        if len(q):
            ahead = lambda k: np.where(q + k < n, points[np.minimum(q + k, n - 1)], 0) * np.where(q + k < n, ~first[np.minimum(q + k, n - 1)], False)
            one = ahead(1)
            two = np.where(one > 0, ahead(2), 0)
            short = np.isin(one, [ord(c) for c in SHORT_ENDINGS])
            long = np.zeros(len(q), dtype=bool)
            for a, b in LONG_ENDINGS:
                long |= (one == ord(a)) & (two == ord(b))
            for hit, size in ((short, 2), (long & ~short, 3)):
                at = q[hit]
                start[at + 1] = False
                ends = at + size
                start[ends[ends < n]] = True
        return np.flatnonzero(start)

    def spans(self, texts: list[str]) -> "Spans":
        """The pre-tokens of the texts, equal ones found by their hash, which is the same in every call."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) for t in texts], out=offsets[1:])
        if not len(points):
            none = np.zeros(0, dtype=np.int64)
            return Spans("", none, none, none.view(np.uint64), none, np.zeros(len(texts) + 1, dtype=np.int64))
        starts = self.starts(points, offsets)
        ends = np.append(starts[1:], len(points))
        if self._power.shape[1] <= len(points):
            base = 0x9E3779B97F4A7C15
            self._power = np.ones((2, max(len(points) + 1, 1 << 20)), dtype=np.uint64)
            for row, x in enumerate((base, pow(base, -1, 1 << 64))):
                self._power[row, 1:] = x
                self._power[row] = np.multiply.accumulate(self._power[row])
        total = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum(self._hash[points] * self._power[0, : len(points)], out=total[1:])
        keys = mix((total[ends] - total[starts]) * self._power[1, starts] + (ends - starts).astype(np.uint64))
        codes, unique = pd.factorize(keys)
        seen = np.zeros(len(unique), dtype=np.int64)
        seen[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        return Spans(joined, starts[seen], ends[seen], unique, codes, np.searchsorted(starts, offsets))

    def distinct(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct pre-tokens, the number of each pre-token in a row, and the bounds of each text in that row."""
        found = self.spans(texts)
        return found.strings(), found.codes, found.bounds


@dataclass
class Spans:
    """Pre-tokens of some texts: where each distinct one stands and its hash, the number of each in a row, the bounds of each text in that row."""

    joined: str
    starts: np.ndarray
    ends: np.ndarray
    keys: np.ndarray
    codes: np.ndarray
    bounds: np.ndarray

    def strings(self, which=slice(None)) -> list[str]:
        return [self.joined[a:b] for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist())]


@lru_cache(maxsize=2)
def load(path: str):
    """The library's tokenizer of a file and its splitter; once per process."""
    # Spark runs one task per core already.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, Splitter(tokenizer)


@lru_cache(maxsize=2)
def at_blanks(path: str):
    """The file's tokenizer, but cutting texts before each blank and nowhere else; once per process."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

    tokenizer = Tokenizer.from_file(path)
    tokenizer.pre_tokenizer = Sequence([Split(" ", "merged_with_next"), ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer


@lru_cache(maxsize=2)
def token_bytes(path: str) -> np.ndarray:
    """How many bytes each id stands for: one character of the file for each."""
    vocab = json.load(open(path, encoding="utf-8"))["model"]["vocab"]
    out = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
    out[list(vocab.values())] = [len(token) for token in vocab]
    return out


@lru_cache(maxsize=2)
def merges(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Sorted pair keys, rank and merged id of each, id of each byte, and the vocabulary's size."""
    model = json.load(open(path, encoding="utf-8"))["model"]
    vocab = model["vocab"]
    size = max(vocab.values()) + 1
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], dtype=np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
    order = np.argsort(keys)
    return keys[order], order, made[order], size


def byte_ids(path: str) -> np.ndarray:
    """The vocabulary's id of each byte value.

    Printable Latin-1 bytes stand for themselves in the file; the others, in
    order, are the characters from U+0100 on.
    """
    vocab = json.load(open(path, encoding="utf-8"))["model"]["vocab"]
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in plain]
    chars = {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}
    return np.array([vocab[chars[b]] for b in range(256)], dtype=np.int64)


def special_strings(path: str) -> dict[str, int]:
    """Added tokens that the library finds inside texts by default."""
    return {t["content"]: t["id"] for t in json.load(open(path, encoding="utf-8")).get("added_tokens", [])}


def pieces(texts: list[str], special: dict[str, int]) -> tuple[list[str], list[int], list[int]]:
    """Texts cut at special strings: the parts, the text each belongs to, and the special id after it (-1: none)."""
    parts, owner, after = [], [], []
    names = sorted(special, key=len, reverse=True)
    for i, text in enumerate(texts):
        while True:
            found = min(((text.find(n), -len(n), n) for n in names if n in text), default=None)
            owner.append(i)
            if found is None:
                parts.append(text)
                after.append(-1)
                break
            at, _, name = found
            parts.append(text[:at])
            after.append(special[name])
            text = text[at + len(name) :]
    return parts, owner, after
