import random

import pytest
from helpers import rows

from firstlight.operators.pages import ranged_page, read_ranged, write_ranged
from firstlight.operators.search import paginate

SORT = [("score", "desc"), ("tag", "asc"), ("id", "asc")]


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(8)
    return spark.createDataFrame([(i, rnd.choice([None, 1.0, 2.0, 3.0]), rnd.choice(["a", "b", None])) for i in range(500)], "id int, score double, tag string")


@pytest.fixture(scope="module")
def table(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ranged") / "t")
    write_ranged(data, path, SORT, parts=7)
    return path


def test_pages_equal_counting_off(spark, data, table):
    laid = read_ranged(spark, table)
    for page, size in ((1, 10), (3, 64), (50, 10), (25, 20), (51, 10), (1, 1000)):
        got = sorted(tuple(r) for r in ranged_page(laid, SORT, page, size).select("place", "id").collect())
        want = [r["id"] for r in paginate(data, SORT, page, size).collect()]
        assert [i for _, i in got] == want
        assert [p for p, _ in got] == [(page - 1) * size + 1 + i for i in range(len(want))]


def test_pages_of_a_filtered_table(spark, data, table):
    keep = "tag = 'a' AND id % 3 = 0"
    got = sorted(tuple(r) for r in ranged_page(read_ranged(spark, table).filter(keep), SORT, 3, 11).select("place", "id").collect())
    assert [i for _, i in got] == [r["id"] for r in paginate(data.filter(keep), SORT, 3, 11).collect()]


def test_page_numbers_start_at_one(spark, table):
    with pytest.raises(ValueError):
        ranged_page(read_ranged(spark, table), SORT, 0, 10)


def test_rows_of_one_value(spark, data, table):
    got = read_ranged(spark, table, 2.0).filter("score = 2.0")
    assert rows(got, "id") == rows(data.filter("score = 2.0"), "id")


def test_only_the_parts_of_the_page_are_read(spark, table):
    """Nothing is counted off: no limit and no offset; the page's parts prune the scan at run time."""
    page = ranged_page(read_ranged(spark, table), SORT, 40, 10)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "Limit" not in plan and "Offset" not in plan
    page.collect()
    final = page._jdf.queryExecution().executedPlan()
    scans = [n for n in _nodes(final) if "dynamicpruning" in n.toString().split("\n")[0]]
    assert scans and min(n.metrics().apply("numOutputRows").value() for n in scans if n.nodeName().startswith("Scan")) < 500 // 3


def _nodes(plan):
    out, todo = [], [plan]
    while todo:
        p = todo.pop()
        out.append(p)
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(p.plan())
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return out


def test_empty_table(spark, data, tmp_path):
    path = str(tmp_path / "none")
    write_ranged(data.filter("id < 0"), path, SORT, parts=3)
    assert rows(ranged_page(read_ranged(spark, path), SORT, 1, 5)) == rows(read_ranged(spark, path, 2.0)) == []
