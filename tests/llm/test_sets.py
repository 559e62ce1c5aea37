"""Deduplication, Jaccard join and decontamination against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import fixtures
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firstlight.llm import decontam, exact_dedup, jaccard_join
from firstlight.llm.bloom import bloom
from firstlight.llm.components import components


def lowered(t):
    return (t or "").translate(fixtures.UPPER)


@pytest.mark.parametrize("n", [0, 1, 2, 50, 20_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys, others = rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**63, 20_000).astype(np.uint64)
    f = exact_dedup.FuseFilter.from_bytes(exact_dedup.FuseFilter.build(keys).to_bytes())
    assert f.contains(keys).all()
    assert f.contains(others).mean() < 0.01


def test_dedup(spark):
    got = exact_dedup.dedup(fixtures.docs(spark), bucket_keys=4)
    groups = defaultdict(list)
    for i, t, _ in fixtures.texts():
        groups[lowered(t)].append(i)
    want = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert fixtures.rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    assert exact_dedup.dedup(fixtures.docs(spark, [])).count() == 0
    kept = exact_dedup.without_copies(fixtures.docs(spark))
    assert kept.columns == fixtures.docs(spark).columns
    assert sorted(lowered(r["text"]) for r in kept.collect()) == sorted(groups)


def sets_of(rows, width):
    out = []
    for i, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", lowered(t))
        out.append((i, frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])))
    return out


def plain_groups(rows, width, threshold):
    sets = sets_of(rows, width)
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= threshold * len(x | y):
                root[find(a)] = find(b)
    members = defaultdict(list)
    for a in range(len(sets)):
        members[find(a)].append(sets[a][0])
    least = {r: min((i for i in m if i is not None), default=None) for r, m in members.items()}
    return sorted(((sets[a][0], len(sets[a][1]), least[find(a)]) for a in range(len(sets))), key=repr)


def chain(n, seed):
    """Copies of copies, each a little further off, and some that share only a passage."""
    rng = random.Random(seed)
    rows, words = [], [f"w{rng.randrange(400)}" for _ in range(90)]
    for i in range(n):
        rows.append((i, " ".join(words), None))
        words = list(words)
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
    passage = " ".join(f"p{k}" for k in range(12))
    rows += [(1000 + i, passage + " " + " ".join(f"q{rng.randrange(60)}" for _ in range(rng.randrange(0, 25))), None) for i in range(n)]
    return rows


@pytest.mark.parametrize("rows, width, threshold, most", [(None, 4, 85, 1 << 18), (chain(60, 1), 4, 85, 1 << 18), (chain(60, 2), 5, 80, 20), (chain(40, 3), 1, 60, 1 << 18)])
def test_jaccard_groups(spark, rows, width, threshold, most):
    rows = fixtures.texts() if rows is None else rows
    got = jaccard_join.groups(fixtures.docs(spark, rows), width, threshold, most)
    assert fixtures.rows_of(got, "doc_id", "n_shingles", "component_id") == plain_groups(rows, width, threshold)


def test_jaccard_of_nothing(spark):
    assert jaccard_join.groups(fixtures.docs(spark, [])).count() == 0
    assert jaccard_join.groups(fixtures.docs(spark, [(1, None, None)])).first()["component_id"] == 1
    kept = jaccard_join.one_of_each(fixtures.docs(spark, chain(30, 4)))
    want = [r for r in plain_groups(chain(30, 4), 5, 80) if r[0] == r[2]]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in want)


def test_prefixes_lose_no_link():
    rng = np.random.default_rng(3)
    universe = rng.integers(0, 2**62, 300).astype(np.uint64)
    keys = np.sort(universe[:150])
    counts = rng.integers(2, 90, 150)
    for _ in range(300):
        x = np.unique(rng.choice(universe, 60))
        y = np.unique(np.concatenate([rng.choice(x, len(x) - 4, replace=False), rng.choice(universe, rng.integers(0, 5))]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        (p, m, _), (q, k, _) = (jaccard_join.prefix(s, jaccard_join.holders_of(s, keys, counts), 80) for s in (x, y))
        least = min(m, k)
        cut = lambda s, pre: pre[: len(s) - jaccard_join.least_shared(len(s), 80) + least]
        assert len(np.intersect1d(cut(x, p), cut(y, q))) >= least


def test_parity_bits_never_exceed_the_difference(spark):
    rng = np.random.default_rng(8)
    sets, rows = [], []
    for i in range(60):
        base = sets[-1] if i % 3 else np.unique(rng.integers(0, 2**63, rng.integers(0, 400)).astype(np.uint64))
        fresh = rng.integers(0, 2**63, rng.integers(1, 30)).astype(np.uint64)
        sets.append(np.unique(np.concatenate([base[rng.random(len(base)) < 0.95], fresh])))
        rows.append((i, len(sets[-1]), *jaccard_join.parity(sets[-1]).tolist()))
    table = spark.createDataFrame(rows, ", ".join(["class long, n long", *(f"{p} long" for p in jaccard_join.PARITY)]))
    both = table.alias("x").join(table.alias("y"), F.col("x.class") < F.col("y.class"))
    for threshold in (50, 85, 100):
        near = {tuple(r) for r in both.filter(jaccard_join._near("x", "y", threshold)).select("x.class", "y.class").collect()}
        linked = set()
        for i, a in enumerate(sets):
            for j in range(i + 1, len(sets)):
                shared = len(np.intersect1d(a, sets[j]))
                if 100 * shared >= threshold * (len(a) + len(sets[j]) - shared):
                    linked.add((i, j))
        assert linked <= near and len(near) < 60 * 59 / 2
        assert linked or threshold == 100


def test_bloom_never_loses_a_key(spark):
    rows = spark.range(5000).selectExpr("array(xxhash64(id), xxhash64(id % 50)) AS keys")
    f = bloom(rows, 10_000, least=2)
    often = np.array([r[0] for r in spark.range(50).selectExpr("xxhash64(id)").collect()])
    once = np.array([r[0] for r in spark.range(50, 5000).selectExpr("xxhash64(id)").collect()])
    assert f.contains(often).all() and f.contains(once).mean() < 0.05


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 100), (7, 7)]
    got = components(spark.createDataFrame(edges, "u long, v long"))
    assert fixtures.rows_of(got, "node", "root") == sorted([(i, 0) for i in range(41)] + [(i, 100) for i in (100, 101, 102)], key=repr)


BENCHMARK = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("window", T.StringType())])


def plain_decontam(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    out = []
    for i, t, _ in rows:
        w, hit, names = words(t), set(), set()
        for item, text, _ in items:
            v = words(text)
            size = min(10, len(v))
            cut = {tuple(v[k : k + size]) for k in range(len(v) - size + 1)} if v else set()
            for a in range(len(w) - size + 1 if v else 0):
                if tuple(w[a : a + size]) in cut:
                    hit.update(range(a, a + size))
                    names.add(str(item))
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_decontamination(spark):
    rows = [r for r in fixtures.texts() if r[0] != 400]
    source = next(t for i, t, _ in rows if i == 100).split()
    items = [(1, " ".join(source[20:45]).upper(), "x"), (2, "A b. C", "x"), (3, "twice", "x"), (4, None, "x"), (5, "", "x"), (6, "日本語のテキスト", "x")]
    items += [(7, "never " * 12, "x"), (12, " ".join(source[20:45]), "x"), (3, "twice", "x")]
    b = spark.createDataFrame(items, BENCHMARK)
    got = decontam.decontaminate(fixtures.docs(spark, rows), b)
    want = plain_decontam(rows, items)
    assert fixtures.rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    clean = decontam.without_benchmark(fixtures.docs(spark, rows), b)
    assert clean.columns == fixtures.docs(spark, []).columns and clean.count() == sum(not r[5] for r in want)
    nothing = decontam.decontaminate(fixtures.docs(spark, rows[:3]), spark.createDataFrame([], BENCHMARK))
    assert [r["contaminated"] for r in nothing.collect()] == [False] * 3
    assert decontam.decontaminate(fixtures.docs(spark, []), b).count() == 0


def test_only_built_in_functions_run(spark, capsys):
    b = spark.createDataFrame([(1, "a b c", "x")], BENCHMARK)
    plan = decontam.decontaminate(fixtures.docs(spark, [(1, "a b c", None)]), b)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
