"""Disguises reach the lattice whole."""

import pyarrow as pa
import pytest

from firstlight.llm import toxicity
from firstlight.llm.tables import table


@pytest.fixture(scope="module")
def characters(spark):
    texts = table(spark, "/root/testdata/sf0.01", "documents").limit(300).toPandas()["text"].tolist()
    words = ["idiot", "stupid", "loser", "asshole", "useless", "shit", "fuck", "ass", "a"] * 40
    # Letter by letter, so that how plain words are told does not matter.
    data = pa.array(texts + [" ".join(words)])
    tokens = toxicity.Tokens(data)
    counts = tokens.trigrams().astype(float)
    for word in words:
        row = [0, 0, *(ord(c) - 96 for c in word), 0]
        for a, b, c in zip(row, row[1:], row[2:]):
            counts[a, b, c] += 1
    return toxicity.CharModel(counts)


@pytest.mark.parametrize(
    "written, meant",
    [
        ("a$$", "ass"), ("@$$hole", "asshole"), ("sh17", "shit"), ("u53l355", "useless"), ("455", "ass"), ("a l o s e r", "a loser"),
        ("i d 1 o t", "idiot"), ("f**k", "fuck"), ("iddiot", "idiot"), ("river!", "river"), ("(river)", "river"), ("loser 7", "loser"),
    ],
)
def test_disguises(characters, written, meant):
    tokens = toxicity.Tokens(pa.array([written]))
    plain = [bytes(tokens.data[a:b]).decode() for a, b in zip(tokens.starts, tokens.ends)]
    assert meant in [characters.restore(w) for w in tokens.disguised] + plain
