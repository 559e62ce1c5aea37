import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from firstlight.operators import sale
from firstlight.plans import dashboard

USERS = [(1, "M", 19, 1, 10), (2, "F", 20, 2, 10), (3, "M", 30, 3, 11), (4, "F", 31, 3, 11), (5, None, None, None, 12)]
SKUS = [(7, "red ring", "t1", "X"), (8, "blue rod", "t2", "Y"), (9, "Ring 海", "t1", "X")]
LINES = [
    (f"{o}-{n}", o, u, s, 9.5, d)
    for o, n, u, s, d in [
        (1, 1, 1, 7, "2024-01-01"), (1, 2, 1, 8, "2024-01-01"), (2, 1, 2, 7, "2024-01-01"), (3, 1, 3, 9, "2024-01-01"),
        (4, 1, 4, 7, "2024-01-01"), (4, 1, 4, 8, "2024-01-01"), (5, 1, 5, 7, "2024-01-01"), (6, 1, 6, 99, "2024-01-01"),
        (7, 1, 1, 7, "2024-01-02"), (8, 1, 4, 9, "2024-01-02"), (9, 1, 4, 9, "2019-03-04"), (9, 2, 2, 8, "2019-03-04"),
    ]
]


@pytest.fixture(scope="module")
def tables(spark):
    return (
        spark.createDataFrame(LINES, "order_detail_id string, order_id long, user_id long, sku_id long, sku_price double, dt string"),
        spark.createDataFrame(USERS, "user_id long, user_gender string, user_age int, user_level int, region_id int"),
        spark.createDataFrame(SKUS, "sku_id long, sku_name string, sku_tm_id string, category string"),
    )


@pytest.fixture(scope="module")
def sales(tables):
    return sale.build_sale_detail(*tables)


def ids(df):
    return [r["order_detail_id"] for r in df.collect()]


def test_lines_without_a_match_stay(sales):
    assert sales.columns == sale.SALE_DETAIL_COLUMNS and sales.count() == len(LINES)
    assert rows(sales.filter("order_id = '6'"), "user_gender", "sku_name") == [(None, None)]


def test_filters(sales):
    day = "2024-01-01"
    assert sale.sale_detail_search(sales, day).count() == 8
    assert sale.sale_detail_search(sales, day, "").count() == 8
    assert sorted(ids(sale.sale_detail_search(sales, day, "RING"))) == ["1-1", "2-1", "3-1", "4-1", "5-1"]
    assert sorted(ids(sale.sale_detail_search(sales, day, "ring", level=3))) == ["3-1", "4-1"]
    assert rows(sale.sale_detail_total(sale.sale_detail_search(sales, "1999-01-01"))) == [(0,)]


def test_pages(sales):
    found = sale.sale_detail_search(sales, "2024-01-01")
    pages = [ids(sale.sale_detail_page(found, p, 3)) for p in (1, 2, 3, 4)]
    assert pages == [["1-1", "1-2", "2-1"], ["3-1", "4-1", "4-1"], ["5-1", "6-1"], []]


def test_pages_are_cut_before_the_joins(tables, sales):
    lines, users, skus = tables
    for page in (1, 2, 3, 4):
        want = sale.sale_detail_page(sale.sale_detail_search(sales, "2024-01-01"), page, 3).collect()
        cut = sale.page_of_lines(lines.filter("dt = '2024-01-01'"), users, skus, page, 3)
        assert cut.collect() == want and cut.columns == sale.SALE_DETAIL_COLUMNS


def test_shares(sales, tables):
    day = "2024-01-01"
    found = sale.sale_detail_search(sales, day)
    groups = sale.user_groups(found)
    ages = rows(sale.age_facet(groups), "name", "value", "pct")
    assert {n: v for n, v, _ in ages} == {"20岁以下": 2, "20-30岁": 2, "30岁以上": 2}
    assert sum(p for _, _, p in ages) == pytest.approx(100)
    genders = rows(sale.gender_facet(groups), "name", "value", "pct")
    assert {n: v for n, v, _ in genders} == {"男": 3, "女": 3}
    before_join = sale.user_groups(tables[0].filter(f"dt = '{day}'"), tables[1])
    assert rows(sale.age_facet(before_join)) == rows(sale.age_facet(groups))


def test_region_and_category(spark, tables):
    lines, users, skus = tables
    regions = spark.createDataFrame([(10, "north"), (11, "south"), (12, "west")], "region_id int, name string")
    sold = lines.selectExpr("user_id", "100.0d AS value")
    assert rows(sale.region_sales(sold, users, regions)) == [("north", 500.0, 5), ("south", 500.0, 5), ("west", 100.0, 1)]
    num = lines.selectExpr("sku_id", "1L AS num")
    got = {r["name"]: r["num"] for r in sale.category_sales(num, skus).collect()}
    assert got == {"X": 8, "Y": 3, None: 1}


@pytest.fixture(scope="module")
def grid(spark, sales, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("grid") / "table")
    sale.write_sale_detail(sales, path, parts=5)
    return path


@pytest.fixture(scope="module")
def ask(spark, grid):
    return lambda *a: json.loads(dashboard.sale_detail_response(spark, grid, *a).first()["body"])


def test_grid_response(ask):
    day = "2024-01-01"
    body = ask(4, 1, 10, day, "ring")
    assert body["draw"] == 4 and body["data"]["total"] == 5
    assert [r["order_detail_id"] for r in body["data"]["detail"]] == ["1-1", "2-1", "3-1", "4-1", "5-1"]
    age, gender = (s["options"] for s in body["data"]["stat"])
    assert {o["name"]: o["value"] for o in age} == {"20岁以下": 1, "20-30岁": 2, "30岁以上": 1}
    assert {o["name"]: o["value"] for o in gender} == {"男": 2, "女": 2}
    empty = ask(1, 1, 10, "1999-01-01")
    assert empty["data"] == {"total": 0, "detail": [], "stat": [{"options": []}, {"options": []}]}
    assert len(ask(1, 1, 5000, day)["data"]["detail"]) == 8
    assert [o["order_detail_id"] for o in ask(1, 2, 2, day, "ring", 3)["data"]["detail"]] == []
    assert [o["order_detail_id"] for o in ask(1, 1, 1, day, "ring", 3)["data"]["detail"]] == ["3-1"]


def test_grid_pages_of_a_day(ask, sales):
    found = sale.sale_detail_search(sales, "2024-01-01")
    for page in (1, 2, 3, 4):
        want = [r["order_detail_id"] for r in sale.sale_detail_page(found, page, 3).collect()]
        assert [r["order_detail_id"] for r in ask(1, page, 3, "2024-01-01")["data"]["detail"]] == want


def test_grid_has_the_default_date(ask):
    body = ask(1, 1, 10)
    assert body["data"]["total"] == 2 and {r["dt"] for r in body["data"]["detail"]} == {"2019-03-04"}


def test_grid_counts_in_one_aggregation(spark, grid):
    found = sale.sale_detail_search(sale.read_sale_detail(spark, grid, "2024-01-01"), "2024-01-01")
    plan = sale.search_counts(found)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    assert "ReadSchema: struct<user_gender:string,user_age:int,dt:string>" in plan
    page = dashboard.sale_detail_response(spark, grid, 1, 1, 2, "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert page.count("FileScan") == 1 and "part#" in page.split("PartitionFilters: [")[1].split("]")[0]


def test_named_list(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "name string, num long")
    assert dashboard.named_list(df, "name", "num", wrap="data").first()["body"] == '{"data":[{"name":"a","num":1},{"name":"b","num":2}]}'


def test_a_day_is_read_from_its_parts(spark, sales, grid):
    table = sale.read_sale_detail(spark, grid)
    assert rows(table.drop("part")) == rows(sales)
    found = sale.read_sale_detail(spark, grid, "2024-01-02")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(dt,2024-01-02)" in plan and "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(ids(found)) == ["7-1", "8-1"]
    assert len(rows(found.select("part").distinct())) < table.select("part").distinct().count()


def test_fractions_are_summed_before_they_are_cut(spark):
    skus = spark.createDataFrame([(1, "x"), (2, "x")], "sku_id long, category string")
    lines = spark.createDataFrame([(1, 0.6), (1, 0.6), (2, 0.8)], "sku_id long, num double")
    sales = lines.withColumn("num", F.col("num").cast("decimal(18,4)"))
    assert rows(sale.category_sales(sales, skus)) == [("x", 2)]


def test_matching_lines_join_only_what_they_filter(spark):
    detail = spark.createDataFrame([(1, 1, 1), (2, 2, 2), (3, 9, 1)], "order_id long, user_id long, sku_id long")
    users = spark.createDataFrame([(1, 3), (2, 4)], "user_id long, user_level int")
    skus = spark.createDataFrame([(1, "red ring"), (2, "blue")], "sku_id long, sku_name string")
    found = lambda *a: sorted(r["order_id"] for r in sale.matching_lines(detail, users, skus, *a).collect())
    assert (found(), found("red"), found("red", 3), found("", 4)) == ([1, 2, 3], [1, 3], [1], [2])
    assert "Join" not in sale.matching_lines(detail, users, skus)._jdf.queryExecution().executedPlan().toString()
