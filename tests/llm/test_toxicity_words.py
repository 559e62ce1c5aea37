"""Words at the edges of a chunk, and features of documents."""

import numpy as np
import pyarrow as pa
import pytest

from firstlight.llm import toxicity

TEXTS = ["(", None, "", "() (a) ((x) 123 999", "river stone river 1d1ot", "l o s e r 1d1ot ox", "a$$ !!! ((( stone"]


@pytest.mark.parametrize("first", ["(", "!!!", "(((", "|+", "()"])
def test_a_chunk_may_begin_with_look_alikes_alone(first):
    words = toxicity.Tokens(pa.array([first, "river"]))
    assert words.doc.tolist() == [1] and words.disguised in ([], [first])


def test_a_document_has_each_feature_once():
    restore = toxicity.restorer(np.ones((toxicity.CharModel.SIZE,) * 3))
    words = toxicity.Tokens(pa.array(TEXTS, pa.string()))
    keys, doc = words.features(restore)
    features, which, owner = words.document_features(restore)
    found = list(zip(owner.tolist(), features[which].tolist()))
    assert len(found) == len(set(found))
    assert set(found) == {(d, k) for d, row in zip(doc.tolist(), keys.tolist()) for k in row}
    _, which, owner = words.document_features(restore, lambda k: np.zeros(k.shape, dtype=bool))
    assert not len(which) and not len(owner)
