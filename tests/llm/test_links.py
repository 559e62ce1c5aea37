"""Links of the similarity join against a comparison of all pairs."""

import fixtures
import numpy as np
import pyarrow as pa
import pytest

from firstlight.llm import jaccard_join

WORDS = [f"w{i}" for i in range(60)]
# Three texts that link pairwise, a copy of one, and texts that link with nothing.
ROWS = [(i, " ".join([*WORDS[:k], "odd", *WORDS[k:]]), "en") for i, k in enumerate((0, 1, 2))]
ROWS += [(9, ROWS[0][1], "en"), (10, "other words stand here", "en"), (11, None, None), (12, "", "en"), (13, "a b", "en")]


@pytest.mark.parametrize("rows, threshold", [(ROWS, 80), (fixtures.texts(), 60)])
def test_all_links_are_listed_and_counted(spark, rows, threshold):
    sets = jaccard_join.shingle_sets(pa.RecordBatch.from_pydict({"text": pa.array([t for _, t, _ in rows], pa.string())}), 4)
    share = lambda p, q: len(np.intersect1d(p, q))
    link = lambda p, q: len(p) and len(q) and 100 * share(p, q) >= threshold * (len(p) + len(q) - share(p, q))
    want = [(r[0], sum(bool(link(p, q)) for j, q in enumerate(sets) if j != i)) for i, (r, p) in enumerate(zip(rows, sets))]
    docs = fixtures.docs(spark, rows)
    got = jaccard_join.linked_groups(docs, 4, threshold)
    assert fixtures.rows_of(got, "doc_id", "n_links") == sorted(want, key=repr)
    names = ("doc_id", "n_shingles", "component_id", "class_size")
    assert fixtures.rows_of(got, *names) == fixtures.rows_of(jaccard_join.groups(docs, 4, threshold), *names)
    links, members = jaccard_join.pairs(docs, 4, threshold)
    hashes = jaccard_join.set_hashes(sets).view(np.int64).tolist()
    want = {tuple(sorted((hashes[i], hashes[j]))) for i in range(len(rows)) for j in range(i) if hashes[i] != hashes[j] and link(sets[i], sets[j])}
    assert sorted((r["u"], r["v"]) for r in links.collect()) == sorted(want)
    assert members.count() == sum(len(s) > 0 for s in sets)


def passages(copies):
    """In each copy, of words of its own, 12 texts that share one passage and differ in the rest."""
    own = lambda c, i: " ".join(f"c{c}d{i}w{k}" for k in range(40))
    return [(100 * c + i, own(c, i) + " " + " ".join(f"c{c}p{k}" for k in range(30)), "en") for c in range(copies) for i in range(12)]


def test_the_index_grows_with_the_corpus(spark):
    def joined(rows):
        index = jaccard_join._indexed(fixtures.docs(spark, rows), 5, 80, 1)[2]
        n_pairs = index.groupBy("token").count().selectExpr("sum(count * (count - 1) / 2)").first()[0] or 0
        return index.count(), n_pairs

    (few_rows, few), (many_rows, many) = joined(passages(2)), joined(passages(8))
    assert many_rows <= 5 * few_rows and many <= 5 * few + many_rows
    assert many <= 4 * many_rows
