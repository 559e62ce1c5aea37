"""Merge-dropout: each part of each document is segmented by its own key."""

import fixtures
import numpy as np

from firstlight.llm import sentencepieces

PIECES = fixtures.path("piece_bpe_32k.model")
DOCS = sentencepieces.mix(np.arange(4000, dtype=np.uint64))


def test_a_tenth_of_the_candidates_at_a_place_is_dropped():
    limit = sentencepieces._threshold(0.1)
    for number in (0, 7):
        keys = sentencepieces.part_keys(20, DOCS, np.full(len(DOCS), number))
        assert len(np.unique(keys)) == len(DOCS)
        for place in ((0, 1, 2), (1, 2, 3), (0, 2, 5)):
            share = (sentencepieces.candidate_hash(keys, *place) < limit).mean()
            assert 0.08 < share < 0.12, (number, place, share)


def test_a_word_has_many_segmentations():
    ids, n = sentencepieces.Encoder(sentencepieces.load(PIECES), 0.1)(["international"] * len(DOCS), DOCS)
    ends = np.cumsum(n)
    assert len({tuple(ids[e - k : e].tolist()) for e, k in zip(ends, n)}) > 20


def test_shared_work_changes_no_segmentation():
    pieces = sentencepieces.load(PIECES)
    rng = np.random.default_rng(2)
    words = ["▁the", "▁international", "▁of", "▁naïve", "▁日本語", "▁a", "▁" + "ab" * 20, "▁" + "lower" * 20]
    word = rng.integers(0, len(words), 3000)
    keys = sentencepieces.part_keys(20, DOCS[:3000], np.arange(3000))
    for dropout in (0.1, 0.5, 1.0):
        encoder = sentencepieces.Encoder(pieces, dropout)
        symbols, count, result = encoder._encode(words, word, keys)
        ends = np.cumsum(count)
        for o in range(0, 3000, 5):
            want = sentencepieces.encode_by_agenda(pieces, words[word[o]], int(keys[o]), dropout)
            want = [b for s in want for b in pieces.with_bytes(s)]
            assert symbols[ends[result[o]] - count[result[o]] : ends[result[o]]].tolist() == want
