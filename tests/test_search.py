import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from firstlight.functions.predicates import bin_values, bool_query, term_in_array
from firstlight.functions.text import highlight, match_text, query_terms, tokens
from firstlight.operators.documents import documents_from_json, read_documents, upsert_documents
from firstlight.operators.search import page_of_row, paginate, search, search_after
from firstlight.schemas import NESTED_DOC

MOVIES = [
    '{"id":1,"name":"Operation Red River","doubanScore":8.0,"actorList":[{"id":1,"name":"wei"},{"id":3,"name":"han yu"}]}',
    '{"id":2,"name":"红海行动","doubanScore":9.0,"actorList":[{"id":7,"name":"胡歌"}]}',
    '{"id":3,"name":"red dawn","doubanScore":8.0,"actorList":[{"id":3,"name":"han yu"}]}',
    '{"id":4,"name":"redder","doubanScore":9.5,"actorList":[{"id":3,"name":"han yu"}]}',
    '{"id":5,"name":"River of no return","doubanScore":7.5,"actorList":[{"id":4,"name":"han"}]}',
    '{"id":6,"name":"海 red-river!","doubanScore":null,"actorList":[{"id":3,"name":"han yu"}]}',
]


@pytest.fixture(scope="module")
def movies(spark):
    return documents_from_json(spark, MOVIES, NESTED_DOC)


def test_must_filter_sort_page_highlight(movies):
    hits = search(
        movies,
        must=[match_text(F.col("name"), "RED river")],
        filters=[term_in_array(F.col("actorList"), "name", "han yu")],
        sort=[("doubanScore", "desc"), ("id", "asc")],
        highlights={"name": "RED river"},
    )
    assert [(r["id"], r["name_hl"]) for r in hits.collect()] == [
        (1, "Operation <em>Red</em> <em>River</em>"),
        (3, "<em>red</em> dawn"),
        (6, "海 <em>red</em>-<em>river</em>!"),
    ]
    assert dict(movies.dtypes)["doubanScore"] == "float"


def test_term_is_exact(movies):
    assert rows(movies.filter(term_in_array(F.col("actorList"), "name", "han")), "id") == [(5,)]


def test_han_tokens(movies):
    assert query_terms("红海 RED, 7x") == ["红", "海", "red", "7x"]
    assert rows(movies.filter(match_text(F.col("name"), "海")), "id") == [(2,), (6,)]
    assert rows(movies.filter(match_text(F.col("name"), "海 red", operator="and")), "id") == [(6,)]
    assert movies.filter(match_text(F.col("name"), " ,; ")).count() == 0


def test_match_equals_token_comparison(spark):
    """The one-expression match against overlap of token arrays, on random mixed texts."""
    rnd = random.Random(11)
    alphabet = ["red", "Red", "é", "ring", "海", "红", "ſ", "7", "_", "-", " ", " ", ".", "\n", "ß", "İ", "x"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for q in ("red", "ring 海", "é 7", "x红", "redring", "ß"):
        terms = F.array(*[F.lit(t) for t in query_terms(q)])
        tok = tokens(F.col("t"))
        for op, want in (("or", F.arrays_overlap(tok, terms)), ("and", F.size(F.array_intersect(tok, terms)) == F.size(terms))):
            assert df.filter(match_text(F.col("t"), q, op) != want).count() == 0


def test_highlight_markers(spark):
    df = spark.createDataFrame([("a cat, Cat; concat",)], "t string")
    assert df.select(highlight(F.col("t"), "cat", "$<", ">\\")).first()[0] == "a $<cat>\\, $<Cat>\\; concat"


def test_pages_and_keyset_agree(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice([None, 1.0, 2.0, 3.0]), rnd.choice(["a", "b", None])) for i in range(57)]
    df = spark.createDataFrame(data, "id int, score double, tag string")
    sort = [("score", "desc"), ("tag", "asc"), ("id", "asc")]
    by_number, by_key, last = [], [], None
    for page in range(1, 8):
        by_number += [tuple(r) for r in paginate(df, sort, page, 10).collect()]
        rows_ = search_after(df, sort, last, 10).collect()
        by_key += [tuple(r) for r in rows_]
        if rows_:
            last = [rows_[-1][c] for c, _ in sort]
    assert by_number == by_key and sorted(r[0] for r in by_key) == list(range(57))
    with pytest.raises(ValueError):
        paginate(df, sort, 0, 10)


def test_page_of_row():
    assert [page_of_row(s, 10) for s in (0, 10, 25)] == [1, 2, 3]


def test_empty_bool_query(movies):
    assert movies.filter(bool_query()).count() == len(MOVIES)


def test_bins(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 99.0, 100.0, 250.0, 599.0, 600.0, 601.0, None)], "v double")
    got = [r[0] for r in df.select(bin_values(F.col("v"), (0, 100, 200, 300, 400, 500, 600))).collect()]
    assert got == [None, 0, 0, 1, 2, 5, 5, None, None]


def test_documents_last_write_wins(spark, movies, tmp_path):
    path = str(tmp_path / "docs")
    assert read_documents(spark, path, NESTED_DOC).count() == 0
    upsert_documents(movies, path, 0)
    upsert_documents(documents_from_json(spark, ['{"id":3,"name":"new","doubanScore":1.0,"actorList":[]}'], NESTED_DOC), path, 1)
    back = read_documents(spark, path, NESTED_DOC)
    assert back.schema == NESTED_DOC and back.count() == len(MOVIES)
    assert rows(back.filter("id IN (1, 3)"), "id", "name") == [(1, "Operation Red River"), (3, "new")]
    upsert_documents(movies, path, 1)  # the same version again
    assert rows(read_documents(spark, path, NESTED_DOC).filter("id = 3"), "name") == [("red dawn",)]


def test_versions_are_merged_by_size(spark, movies, tmp_path):
    """Twenty versions: few folders, each document its newest text, and a held reader reads to its end."""
    from firstlight.operators.documents import live_folders, merge_documents
    from firstlight.sources import folders

    path = str(tmp_path / "docs")
    one = lambda v, *ids: documents_from_json(spark, [f'{{"id":{i},"name":"v{v}","doubanScore":1.0,"actorList":[]}}' for i in ids], NESTED_DOC)
    held = None
    for v in range(20):
        upsert_documents(one(v, v % 7, 100 + v).coalesce(1), path, v)
        if v == 9:
            held = read_documents(spark, path, NESTED_DOC)
            before = rows(held, "id", "name")
        merge_documents(spark, path, NESTED_DOC, small=1 << 10)
        assert len(live_folders(spark, path)) < 8
    want = {v % 7: f"v{v}" for v in range(20)} | {100 + v: f"v{v}" for v in range(20)}
    assert dict(rows(read_documents(spark, path, NESTED_DOC), "id", "name")) == want
    assert rows(held, "id", "name") == before
    merge_documents(spark, path, NESTED_DOC, small=1 << 10, grace=0)
    there = sum(len(folders.numbers(spark, f"{path}/version={v}", "tier")) for v in range(20))
    assert there == len(live_folders(spark, path))
    assert dict(rows(read_documents(spark, path, NESTED_DOC), "id", "name")) == want


def test_a_merge_that_died_is_made_again(spark, tmp_path):
    from firstlight.operators.documents import live_folders, merge_documents
    from firstlight.sources import folders

    path = str(tmp_path / "docs")
    docs = lambda v: documents_from_json(spark, [f'{{"id":1,"name":"v{v}","doubanScore":1.0,"actorList":[]}}'], NESTED_DOC)
    for v in range(4):
        upsert_documents(docs(v).coalesce(1), path, v)
    docs(3).coalesce(1).write.parquet(f"{path}/version=3/tier=1")
    folders.remove(spark, [f"{path}/version=3/tier=1/_SUCCESS"])
    assert len(live_folders(spark, path)) == 4
    assert merge_documents(spark, path, NESTED_DOC) == 1 and live_folders(spark, path) == [(3, 1)]
    assert rows(read_documents(spark, path, NESTED_DOC), "name") == [("v3",)]
