"""Token counts, wavelet files and SentencePiece encoding against the libraries."""

import io
import random
import zlib

import fixtures
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from firstlight.llm import pretokens, sentencepieces, token_counts, wavelet

BPE, PIECES = fixtures.path("byte_bpe_50k.json"), fixtures.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


MIXED = st.text(alphabet=st.sampled_from(list("ab'stmdrevl  \n\t!?12éß日  🎉▁<|>")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(MIXED, min_size=1, max_size=5))
def test_pretokens_are_the_librarys(texts):
    tokenizer, splitter = pretokens.load(BPE)
    words, codes, bounds = splitter.distinct(texts)
    for i, t in enumerate(texts):
        mine = [words[c] for c in codes[bounds[i] : bounds[i + 1]]]
        assert mine == [t[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(t)]


def test_merging_equals_the_library(library):
    rng = random.Random(1)
    words = ["aaaaaaa", "tion", "lowest", "é" * 9, "日本語"] + ["".join(rng.choices("abcdetion", k=rng.randrange(1, 25))) for _ in range(300)]
    symbols, owner = token_counts.Merger(BPE).merge(words)
    for i, w in enumerate(words):
        assert symbols[owner == i].tolist() == library.encode(w, add_special_tokens=False).ids
    assert token_counts.Merger(BPE).counts([]).tolist() == []


def test_counts(spark, library):
    got = fixtures.rows_of(token_counts.count_tokens(fixtures.docs(spark), BPE), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = []
    for i, t, _ in fixtures.texts():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert got == sorted(want, key=repr)
    assert token_counts.count_tokens(fixtures.docs(spark, []), BPE).count() == 0


def test_wavelet_round_trip(spark, library):
    rows = [r for r in fixtures.texts() if r[0] not in (500, 501, None)] + [(None, "null id", None)]
    got = wavelet.round_trip(fixtures.docs(spark, rows), BPE, file_tokens=3000)
    start, want = 0, []
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert fixtures.rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    repeated = wavelet.round_trip(fixtures.docs(spark, [(500, "twice", None)] * 3), BPE)
    assert len({r["start"] for r in repeated.collect()}) == 3
    assert wavelet.round_trip(fixtures.docs(spark, []), BPE).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(MIXED | st.just("a<|endoftext|> b"), min_size=1, max_size=4), min_size=1, max_size=6), st.sampled_from([0, 5, 1 << 20]))
def test_remembered_pretokens_have_the_librarys_ids(calls, most):
    library, encoder = pretokens.load(BPE)[0], wavelet.Encoder(BPE)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(wavelet, "MEMO_ENTRIES", most)
        patch.setattr(wavelet, "JOINED_WORDS", 3)
        for texts in calls + calls:
            ids, n = encoder(texts)
            want = [library.encode(t, add_special_tokens=False).ids for t in texts]
            assert n.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("top", [1, 2, 300, 70_000])
def test_wavelet_queries(top, monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 64)
    rng = np.random.default_rng(top)
    ids = (rng.zipf(1.3, 700) % top).astype(np.uint32)
    matrix = wavelet.WaveletMatrix(io.BytesIO(wavelet.encode_file(ids, np.arange(2), np.array([300, 400]))))
    assert (matrix.all_ids() == ids).all()
    assert [matrix.access(i) for i in range(0, 700, 13)] == ids[::13].tolist()
    for symbol in [*np.unique(ids)[:8].tolist(), int(ids.max()) + 1]:
        at = np.flatnonzero(ids == symbol)
        assert matrix.count(symbol) == len(at)
        assert matrix.count(symbol, 100, 555) == int(((at >= 100) & (at < 555)).sum())
        assert [matrix.occurrence(symbol, k) for k in range(len(at))][:9] == at[:9].tolist()
        with pytest.raises(IndexError):
            matrix.occurrence(symbol, len(at))


def test_pieces_without_dropout_are_the_librarys():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    pieces, texts = sentencepieces.load(PIECES), [t or "" for _, t, _ in fixtures.texts() if "▁" not in (t or "")]
    ids, n = sentencepieces.Encoder(pieces, 0.0)(texts, np.arange(len(texts)).astype(np.uint64))
    ends = np.cumsum(n)
    for t, e, k in zip(texts, ends, n):
        assert ids[e - k : e].tolist() == model.encode(t)


@settings(max_examples=60, deadline=None)
@given(st.lists(MIXED, min_size=1, max_size=4), st.integers(0, 2**40), st.sampled_from([0.1, 0.5, 1.0]))
def test_dropout_is_lossless_and_as_the_agenda(texts, key, dropout):
    pieces = sentencepieces.load(PIECES)
    parts = [p for t in texts for p in sentencepieces.parts(sentencepieces.escape(t))]
    keys = sentencepieces.mix(np.arange(len(parts), dtype=np.uint64) + np.uint64(key))
    symbols, owner = sentencepieces.encode_together(pieces, parts, keys, dropout)
    for i, p in enumerate(parts):
        assert symbols[owner == i].tolist() == sentencepieces.encode_by_agenda(pieces, p, int(keys[i]), dropout)
    ids, n = sentencepieces.Encoder(pieces, dropout, seed=3)(texts, np.arange(len(texts)).astype(np.uint64))
    ends = np.cumsum(n)
    assert [sentencepieces.decode_ids(pieces, ids[e - k : e].tolist()) for e, k in zip(ends, n)] == texts


def test_pieces_round_trip(spark):
    d = fixtures.docs(spark)
    one, again = (fixtures.rows_of(sentencepieces.round_trip(x, PIECES), "doc_id", "n_tokens", "ids_crc32", "lossless") for x in (d, d.repartition(5)))
    other = fixtures.rows_of(sentencepieces.round_trip(d, PIECES, seed=9), "doc_id", "n_tokens", "ids_crc32", "lossless")
    assert one == again and one != other
    assert len(one) == len(fixtures.texts()) and all(r[3] for r in one + other)
    assert sentencepieces.round_trip(fixtures.docs(spark, []), PIECES).count() == 0
