"""SimHash groups against all pairs of fingerprints."""

import random
import re

import fixtures
import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from firstlight.llm import bk_tree
from firstlight.llm.queries import QUERIES


def plain_fingerprint(text, width):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(fixtures.UPPER))
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(ids, fps, radius):
    root = list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        r = find(i)
        least[r] = min((y for y in (least.get(r), x) if y is not None), default=None)
    return [least[find(i)] for i in range(len(fps))]


@pytest.mark.parametrize("width,radius", [(3, 2), (5, 3), (1, 0)])
def test_groups(spark, width, radius):
    rows = fixtures.texts()
    fps = [plain_fingerprint(t, width) for _, t, _ in rows]
    named = plain_groups([i for i, _, _ in rows], fps, radius)
    want = [(i, f"{fp:016x}", c, fps.count(fp)) for (i, _, _), fp, c in zip(rows, fps, named)]
    got = bk_tree.in_hex(fixtures.docs(spark), width, radius)
    assert fixtures.rows_of(got, "doc_id", "fingerprint", "component_id", "copies") == sorted(want, key=repr)


def test_hash_is_the_one_of_sql(spark):
    text = "one Two\tthree "
    hashed = spark.sql("SELECT hex(xxhash64('one two three')) AS h").first()["h"].lower()
    got = bk_tree.in_hex(fixtures.docs(spark, [(1, text, None)]), 3, 2).first()["fingerprint"]
    assert got == hashed.zfill(16)


def test_empty_table_and_no_words(spark):
    assert bk_tree.groups(fixtures.docs(spark, [])).count() == 0
    got = bk_tree.in_hex(fixtures.docs(spark, [(5, None, None), (3, " \n", None), (9, "", None)]), 3, 2)
    assert fixtures.rows_of(got, "doc_id", "fingerprint", "component_id") == [(i, "0" * 16, 3) for i in (3, 5, 9)]


def near(rng, n, bits, middle=None):
    middle = rng.getrandbits(64) if middle is None else middle
    out = set()
    while len(out) < n:
        x = middle
        for _ in range(rng.randrange(bits + 1)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return list(out)


def test_trees_find_all_in_the_radius():
    rng = random.Random(4)
    for radius in (0, 1, 2, 5):
        sizes = [rng.randrange(1, 80) for _ in range(12)]
        fps = [x for n in sizes for x in near(rng, n, 6)]
        forest = bk_tree.Forest(np.array(fps, dtype=np.uint64), np.array(sizes))
        got = {(int(x), int(y)) for a, b in forest.within(radius) for x, y in zip(a, b)}
        ends = np.cumsum([0, *sizes])
        want = {(i, j) for a, b in zip(ends, ends[1:]) for i in range(a, b) for j in range(i + 1, b) if (fps[i] ^ fps[j]).bit_count() <= radius}
        assert got == want


def test_edges_are_distances_to_the_parent():
    rng = random.Random(5)
    fps = near(rng, 200, 20)
    forest = bk_tree.Forest(np.array(fps, dtype=np.uint64), np.array([200]))
    parents, distances = forest.edges // 65, forest.edges % 65
    assert sorted(forest.children.tolist()) == list(range(1, 200))
    assert len(set(forest.edges.tolist())) == 199  # one child for each distance
    assert all((fps[c] ^ fps[p]).bit_count() == d for c, p, d in zip(forest.children, parents, distances))


@pytest.mark.parametrize("most", [4, 64, 4096])
def test_large_shards_are_dealt_again(spark, most):
    """A dense group, most of which shares its blocks; chains of links across shards."""
    rng = random.Random(6)
    fps = near(rng, 250, 6) + near(rng, 40, 3) + [rng.getrandbits(64) for _ in range(60)]
    fps = list(dict.fromkeys(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    rows = spark.createDataFrame([(x,) for x in signed], T.StructType([T.StructField("fp", T.LongType())]))
    found = bk_tree.links(rows, 2, most=most)
    root = {x: x for x in signed}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for u, v in found.collect():
        root[find(u)] = find(v)
    want = plain_groups(list(range(len(fps))), fps, 2)
    of = {}
    assert all(of.setdefault(find(x), g) == g for x, g in zip(signed, want)) and len(of) == len(set(want))
    sizes = [len(r["members"]) for r in bk_tree.shards(rows, 2, most=most).collect()]
    assert max(sizes) <= max(most, 1 << 13)


def test_query_over_the_table(spark):
    got = QUERIES["op12_bk_tree"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i], 3) for i in ids]
    want = {(i, f"{fp:016x}", c) for i, fp, c in zip(ids, fps, plain_groups(ids, fps, 2))}
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == want and len(got) == len(ids)
