"""Language identification, toxicity and context-tree scores: held-out accuracy, and plain versions where they exist."""

import math
import re
import zlib
from collections import Counter
from functools import lru_cache

import fixtures
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from firstlight.llm import context_tree, language_id, toxicity
from firstlight.llm.queries import QUERIES
from firstlight.llm.tables import table

SF = "/root/testdata/sf0.01"


def remainder(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


def test_languages_held_out(spark):
    got = QUERIES["op1_language_id"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_of_odd_rows(spark):
    found = {r["doc_id"]: r for r in language_id.identify_held_out(fixtures.docs(spark)).collect()}
    for i in (200, 201, 202, 203, 304):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    assert found[402]["lang_pred"] in {"en", "de", "fr", "es", "xx"}
    none = language_id.identify_held_out(fixtures.docs(spark, [(1, "text", None)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in none] == [("und", 0.0)]
    one = language_id.identify_held_out(fixtures.docs(spark, [(i, "some text", "en") for i in range(9)])).collect()
    assert {r["lang_pred"] for r in one} == {"en"}
    assert language_id.identify_held_out(fixtures.docs(spark, [])).count() == 0


def test_features_are_of_the_whole_text():
    long = "ab " * 200_000
    x = language_id.features(pa.array([long, long + "xyz" * 1000, None, ""]))
    assert not np.allclose(x[0], x[1]) and not x[2:].any()


def test_families_come_first():
    rng = np.random.default_rng(1)
    x = np.abs(rng.normal(size=(400, 30))).astype(np.float32)
    names = np.array(["en", "de", "fr", "es"] * 100)
    for k, n in enumerate(["en", "de", "fr", "es"]):
        x[names == n, 2 * k : 2 * k + 2] += 3
    model = language_id.Model(x, names.tolist())
    assert model.families == ["germanic", "romance"] and [p[:2] for p in model.pairs["romance"]] == [("es", "fr")]
    assert (model.predict(x)[0] == names).mean() > 0.98


@pytest.fixture(scope="module")
def characters(spark):
    texts = table(spark, SF, "documents").limit(300).toPandas()["text"].tolist()
    words = ["idiot", "stupid", "loser", "worthless", "scum", "clown"] * 40
    return toxicity.CharModel(toxicity.Tokens(pa.array(texts + [" ".join(words)])).trigrams().astype(float))


@pytest.mark.parametrize(
    "written, meant",
    [("1d1ot", "idiot"), ("s t u p i d", "stupid"), ("l.o.s.e.r", "loser"), pytest.param("worth1ess", "worthless", marks=pytest.mark.xfail(reason="open: the trigram model prefers another reading of 1")), ("looooser", "loser"), ("$cum!", "scum"), ("CL0WN", "clown")],
)
def test_disguised_words_are_restored(characters, written, meant):
    tokens = toxicity.Tokens(pa.array([f"the {written} and"]))
    assert [characters.restore(w) for w in tokens.disguised] == [meant]


def test_plain_words_stay(characters):
    tokens = toxicity.Tokens(pa.array(["The (river), flows. Ünder! %%% $$$ a 12 i i", None, ""]))
    assert not tokens.disguised
    assert [bytes(tokens.data[a:b]).decode() for a, b in zip(tokens.starts, tokens.ends)] == "the river flows Ünder a i i".split()


def toxic_table(spark):
    rows, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        word = ["idiot", "1d1ot", "i d i o t", "idiooot"][i % 4] if bad and i > 300 else "idiot" if bad else "river"
        rows.append((i, f"thing over {word} stone light {i % 17}", "en"))
        labels.append((i, int(bad)))
    rows += [(1000, None, None), (1001, "", None), (1002, "stone " * 50_000 + "you IDIOT!", None), (None, "idiot", None), (1003, "idiotic river", None)]
    labels += [(0, None), (None, 1), (5000, 1), (3, 0), (3, 0)]
    return fixtures.docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("quality", F.lit(1)), rows


def test_toxicity(spark):
    docs, labels, rows = toxic_table(spark)
    got = toxicity.score_held_out(docs, labels).collect()
    assert len(got) == len(rows)
    found = {r["doc_id"]: r for r in got}
    assert all(r["held_out"] == (r["doc_id"] is not None and remainder(r["doc_id"], 5) == 0) for r in got)
    assert all(found[i]["predicted"] == (i % 6 == 0) for i in range(600))
    assert [found[i]["predicted"] for i in (1000, 1001, 1002, None)] == [0, 0, 1, 1]
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) for r in got)
    clean = toxicity.without_toxic(docs, toxicity.fit(docs, labels))
    assert clean.columns == docs.columns and clean.count() == sum(r["predicted"] == 0 for r in got)


def test_toxicity_without_labels(spark):
    docs, labels, _ = toxic_table(spark)
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        assert {(r["score"], r["predicted"]) for r in toxicity.score_held_out(docs, none).collect()} == {(0.0, 0)}
    assert toxicity.score_held_out(docs.limit(0), labels).count() == 0


def kt(a, b):
    return math.exp(float(context_tree.log_kt(np.array([a * 1.0]), np.array([b * 1.0]))[0]))


def plain_tree(texts, depth):
    """Probability of a byte after a context, straight from the definition."""
    counts = Counter()
    for t in texts:
        row = bytes([context_tree.END]) * depth + t + bytes([context_tree.END])
        for i in range(depth, len(row)):
            for d in range(depth + 1):
                bits = f"{row[i]:08b}"
                for j in range(8):
                    counts[row[i - d : i], bits[:j], bits[j]] += 1
    contexts = {c for c, _, _ in counts}

    @lru_cache(None)
    def weighted(context, prefix):
        own = kt(counts[context, prefix, "0"], counts[context, prefix, "1"])
        if len(context) == depth:
            return own
        below = [bytes([b]) + context for b in range(256) if bytes([b]) + context in contexts]
        below = [c for c in below if counts[c, prefix, "0"] + counts[c, prefix, "1"]]
        return 0.5 * own + 0.5 * math.prod(weighted(c, prefix) for c in below)

    def chance(context, symbol):
        total = 1.0
        bits = f"{symbol:08b}"
        for j in range(8):
            p, seen = 0.5, False
            for d in range(depth, -1, -1):
                c = context[depth - d :]
                zero, one = counts[c, bits[:j], "0"], counts[c, bits[:j], "1"]
                if zero + one == 0:
                    continue
                own = ((one if bits[j] == "1" else zero) + 0.5) / (zero + one + 1)
                stop = 0.5 * kt(zero, one) / weighted(c, bits[:j]) if seen else 1.0
                p, seen = stop * own + (1 - stop) * p, True
            total *= p
        return total

    return chance


def tree_texts():
    return [(i, t, None) for i, t in enumerate(["abra cadabra", "Abra abracadabra", "", None, "cad", "é ab", "abra abra zebra", "dabra", "quux", "abra cad"])]


def test_tree_equals_the_definition(spark):
    rows = tree_texts()
    train = [context_tree.LOWER[np.frombuffer((t or "").encode(), np.uint8)].tobytes() for i, t, _ in rows if remainder(i, 5) != 1]
    assert len(train) < len(rows)
    depth = context_tree.DEPTH
    chance = plain_tree(train, depth)
    words = lambda t: re.findall(rb"[^\x20\x09-\x0d]+", t)
    counts = Counter(w for t in train for w in words(t)) + Counter({None: len(train)})
    n, v = sum(counts.values()), len(counts)
    docs = fixtures.docs(spark, rows)
    for most in (context_tree.FREQUENT, 3):
        got = {r["doc_id"]: r for r in context_tree.score_held_out(docs, most).collect()}
        assert len(got) == len(rows)
        for i, t, _ in rows:
            low = context_tree.LOWER[np.frombuffer((t or "").encode(), np.uint8)].tobytes()
            row = bytes([context_tree.END]) * depth + low + bytes([context_tree.END])
            want = sum(math.log10(chance(row[k - depth : k], row[k])) for k in range(depth, len(row)))
            tokens = [*words(low), None]
            base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
            r = got[i]
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (remainder(i, 5) == 1, len(tokens), sum(w in counts for w in tokens), n)
            assert math.isclose(r["base_score"], base, rel_tol=1e-9)
            assert math.isclose(r["score"], want, rel_tol=1e-4)


def test_tree_probabilities_sum_to_one():
    keys, n = np.unique(context_tree.pair_keys(pa.array(["abra cadabra", "zebra", None]))[0], return_counts=True)
    levels, summit = context_tree.build(keys, n)
    levels[: context_tree.SPLIT] = context_tree.build_top(*summit)
    for context in (keys[3], keys[7], np.uint64(0x7A7A7A7A7A00)):
        after = (context & ~np.uint64(0xFF)) | np.arange(256, dtype=np.uint64)
        assert math.isclose((10 ** context_tree.log10_of(levels, after)).sum(), 1.0, rel_tol=1e-5)


def test_scores_of_odd_rows(spark):
    got = context_tree.score_held_out(fixtures.docs(spark)).collect()
    assert len(got) == len(fixtures.texts()) and all(r["score"] < 0 and r["base_score"] < 0 for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (200, 201, 202)} == {1}
    assert context_tree.score_held_out(fixtures.docs(spark, [])).count() == 0
    held = next(i for i in range(50) if remainder(i, 5) == 1)
    only = context_tree.score_held_out(fixtures.docs(spark, [(held, "ab", None)])).first()
    assert (only["n_known"], only["train_tokens"]) == (0, 0) and math.isclose(only["score"], -24 * math.log10(2))


def test_tree_beats_the_words(spark):
    held = QUERIES["op2_context_tree"](spark, SF).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]
