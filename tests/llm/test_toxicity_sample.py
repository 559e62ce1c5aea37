"""Toxicity learned from a sample of the labels: scores keep the table's own rate."""

import fixtures
import numpy as np
import pyarrow as pa

from firstlight.llm import toxicity


def test_scores_do_not_depend_on_the_caps(spark):
    rows, labels = [], []
    for i in range(6000):
        bad = i % 10 == 0
        # A third of the rows with ``gloomy`` are toxic, all rows with ``idiot``.
        word = "gloomy" if i % 50 == 0 or (i % 10 == 1 and i % 50 < 21) else "idiot" if bad else "river"
        rows.append((i, f"thing over {word} stone light w{i % 17}", "en"))
        labels.append((i, int(bad)))
    docs, given = fixtures.docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    scores = lambda model: {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    whole, part = scores(toxicity.fit(docs, given)), scores(toxicity.fit(docs, given, toxic=600, clean=600))
    assert max(abs(whole[i] - part[i]) for i in whole) < 0.05
    assert {i for i in whole if part[i] >= 0.5} == {i for i, text, _ in rows if "idiot" in text}


def test_readings_are_kept_between_tasks():
    """A word is read once for a model, whatever task asks; another model reads it anew."""
    counts = np.ones((toxicity.CharModel.SIZE,) * 3)
    first = toxicity.restorer(counts)
    first("1d1ot")
    assert toxicity.restorer(counts.copy()).memo == {"1d1ot": first("1d1ot")}
    assert toxicity.restorer(counts * 2).memo == {}


def test_each_word_is_hashed_once():
    words = toxicity.Tokens(pa.array(["river stone river", None, "stone 1d1ot 1d1ot ox"]))
    restore = toxicity.restorer(np.ones((toxicity.CharModel.SIZE,) * 3))
    keys, at, doc = words.distinct_features(restore)
    assert len(keys) == 4 and len(at) == 7 and sorted(doc.tolist()) == [0, 0, 0, 2, 2, 2, 2]
    assert (words.features(restore)[0] == keys[at]).all()
