"""Every registered query against its SQL."""

import os

import oracle
import pytest

import __spark_entry__ as entry_point

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(set(entry_point.catalog.queries())))
def test_query_equals_sql(spark, con, name):
    df = entry_point.queries()[name](spark, SF)
    sql = entry_point.oracle_sql()[name]
    assert oracle.difference(df, con, sql) is None


def test_entry_has_24_hours(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["hr", "today_n", "yesterday_n"]
    assert df.count() == 24
