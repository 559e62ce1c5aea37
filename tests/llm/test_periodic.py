"""Periodic runs against every period tried at every place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import fixtures
import numpy as np
import pytest

from firstlight.llm import periodic
from firstlight.llm.queries import QUERIES


def plain_runs(w, least=24):
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, 3 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def collapsed(w, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def made(rng):
    k = rng.choice([1, 2, 2, 3, 5, 60])
    w = [f"w{rng.randrange(k)}" for _ in range(rng.randrange(150))]
    for _ in range(rng.randrange(3)):
        u = [f"w{rng.randrange(k)}" for _ in range(rng.randrange(1, 14))]
        at = rng.randrange(len(w) + 1)
        w[at:at] = (u * 40)[: rng.randrange(5, 70)]
    return w


@pytest.mark.parametrize("least", [3, 12, 24, 25])
def test_runs_of_words(least):
    rng = random.Random(least)
    for _ in range(60):
        texts = [made(rng) for _ in range(rng.randrange(1, 6))]
        hashes = periodic.mix(np.array([hash(x) & (1 << 63) - 1 for w in texts for x in w], dtype=np.uint64))
        bounds = np.cumsum([0] + [len(w) for w in texts])
        runs, of = periodic.word_runs(hashes, bounds, least)
        for t, w in enumerate(texts):
            got = [(int(a - bounds[t]), int(b - a), int(q)) for a, b, q in runs[of[t] : of[t + 1]]]
            assert got == plain_runs(w, least)


ROWS = fixtures.texts() + [
    (600, "a " * 23, None), (601, "a " * 24, None), (602, "x " + "a b c " * 8 + "z", None), (603, "a b c d e f g h i " * 2 + "a b c d e f g h", None),
    (604, "Ab ab " * 20, None), (605, "lead " + "q r " * 30 + "mid " + "s t u " * 30, None), (606, "a\n" * 5000, None),
    (607, ("a b " * 12 + "c ") * 4, None), (608, None, None), (609, "\t" + "é ß " * 20, None),
]


def test_operator(spark):
    got = periodic.runs(fixtures.docs(spark, ROWS))
    want = [(i, plain_runs(words_of(t)) if i not in (400, 606) else [(0, 5000, 1)] if i == 606 else [], t) for i, t, _ in ROWS]
    want = sorted(((i, [tuple(r) for r in runs], collapsed(words_of(t), runs)) for i, runs, t in want), key=repr)
    rows = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()]
    assert sorted(rows, key=repr) == want
    assert got.columns == ["doc_id", "runs", "collapsed"]
    assert periodic.digests(fixtures.docs(spark, [])).count() == 0


def digest(doc_id, w):
    runs = plain_runs(w)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *top, None if top[0] is None else 1000 * top[1] // top[2], sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(collapsed(w, runs)))


NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_digests(spark):
    rows = [r for r in ROWS if r[0] not in (400, 606)]
    got = periodic.digests(fixtures.docs(spark, rows))
    assert fixtures.rows_of(got, *NAMES) == sorted((digest(i, words_of(t)) for i, t, _ in rows), key=repr)


def tailed(doc_id, text):
    w = words_of(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_tails(spark):
    rows = [(i, t, None) for i in range(120) for t in (["x y z " * (i % 40), "", None, " lone "][i % 4],)] + [(None, "a b", None)]
    got = periodic.with_tails(fixtures.docs(spark, rows))
    assert sorted((repr(r["doc_id"]), words_of(r["text"])) for r in got.collect()) == sorted((repr(i), tailed(i, t)) for i, t, _ in rows)


def test_query_over_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len(r["text"] or "") < 8000]
    assert len(short) > len(docs) // 2
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in QUERIES["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    assert [got[r["doc_id"]] for r in short] == [digest(r["doc_id"], tailed(r["doc_id"], r["text"])) for r in short]
    assert any(got[r["doc_id"]][1] for r in short)
