"""Responses of the dashboard as one-row frames with a JSON ``body``.

Only bounded results are packed: two KPIs, 24 hours, one page, a few shares.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firstlight.functions.labels import DEFAULT_SALE_DATE
from firstlight.operators.metrics import hourly_compare, kpi_totals
from firstlight.operators.pages import PART, rows_of_page
from firstlight.operators.sale import ALL, BY_AGE, BY_GENDER, BY_PART, SALE_SORT, read_sale_detail, sale_detail_search, search_counts
from firstlight.schemas import SALE_DETAIL_COLUMNS


def _body(df: DataFrame, value: Column) -> DataFrame:
    return df.agg(F.to_json(value).alias("body"))


def _sorted_list(*columns: str) -> Column:
    return F.sort_array(F.collect_list(F.struct(*columns)))


def realtime_total(launched: DataFrame, date: str, first_seen: DataFrame | None = None) -> DataFrame:
    """``[{"id":"dau","name":...,"value":...},{"id":"new_mid",...}]``"""
    return realtime_total_of(kpi_totals(launched, date, first_seen))


def realtime_total_of(kpis: DataFrame) -> DataFrame:
    return _body(kpis, _sorted_list("id", "name", "value"))


def realtime_hour(launched: DataFrame, date: str) -> DataFrame:
    """``{"yesterday":{"11":383,...},"today":{"12":38,...}}``, hours with devices only."""
    return realtime_hour_of(hourly_compare(launched, date))


def realtime_hour_of(compared: DataFrame) -> DataFrame:

    def present(n: str) -> Column:
        entry = F.when(F.col(n) > 0, F.struct("hr", n))
        return F.map_from_entries(F.sort_array(F.collect_list(entry)))

    both = F.struct(present("yesterday_n").alias("yesterday"), present("today_n").alias("today"))
    return _body(compared, both)


def sale_detail_response(
    spark: SparkSession,
    path: str,
    draw: int,
    page: int,
    size: int,
    date: str = DEFAULT_SALE_DATE,
    keyword: str = "",
    level: int | None = None,
) -> DataFrame:
    """``{"draw":..,"data":{"total":..,"detail":[..],"stat":[{"options":[..]},{"options":[..]}]}}``

    ``stat`` holds the age shares, then the gender shares; ``path`` is that of
    :func:`firstlight.operators.sale.write_sale_detail`.  One aggregation over
    the day counts the total, both shares and the rows of each part; the page
    is then read from its parts alone.
    """
    found = sale_detail_search(read_sale_detail(spark, path, date), date, keyword, level)
    # One row per part of the day and a dozen of shares.
    counts = search_counts(found).collect()
    of = lambda level, name: sorted((r[name], r["n"]) for r in counts if r["level"] == level and r[name] is not None)
    total = sum(r["n"] for r in counts if r["level"] == ALL)
    before, ahead = {}, 0
    for part, n in of(BY_PART, PART):
        if ahead < page * size and ahead + n > (page - 1) * size:
            before[part] = ahead
        ahead += n
    rows = found.filter(F.col(PART).isin(list(before)))
    place = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col(PART)] if before else F.lit(0)
    rows = rows_of_page(rows, place, SALE_SORT, page, size)
    lines = F.sort_array(F.collect_list(F.struct("place", F.struct(*SALE_DETAIL_COLUMNS).alias("line"))))

    def options(shares: list[tuple[str, int]]) -> Column:
        items = [F.struct(F.lit(name).alias("name"), F.lit(n).cast("long").alias("value")) for name, n in shares]
        return F.struct((F.array(*items) if items else F.array().cast("array<struct<name:string,value:bigint>>")).alias("options"))

    stat = F.array(options(of(BY_AGE, "age_name")), options(of(BY_GENDER, "gender_name")))
    data = F.struct(F.lit(total).cast("long").alias("total"), F.transform(lines, lambda x: x["line"]).alias("detail"), stat.alias("stat"))
    return _body(rows, F.struct(F.lit(draw).alias("draw"), data.alias("data")))


def named_list(df: DataFrame, *columns: str, wrap: str | None = None) -> DataFrame:
    """``[{...}]`` or ``{"<wrap>":[{...}]}`` of a small result such as regions or categories."""
    rows = _sorted_list(*columns)
    return _body(df, F.struct(rows.alias(wrap)) if wrap else rows)
