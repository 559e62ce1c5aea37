"""Order details: enrichment, search, shares, sales by region and category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firstlight.functions.labels import DEFAULT_SALE_DATE, REGION_SPLITS, age_band, gender_name
from firstlight.functions.predicates import bin_values
from firstlight.functions.text import match_text
from firstlight.operators.metrics import with_pct
from firstlight.operators.pages import PART, read_ranged, write_ranged
from firstlight.operators.search import paginate
from firstlight.schemas import SALE_DETAIL_COLUMNS


def build_sale_detail(detail: DataFrame, users: DataFrame, skus: DataFrame) -> DataFrame:
    """Order lines with the attributes of their user and SKU; lines without a match stay.

    ``detail``: order_detail_id, order_id, user_id, sku_id, sku_price, dt;
    ``users``: user_id, user_gender, user_age, user_level; ``skus``: sku_id,
    sku_name, sku_tm_id.  No broadcast is forced: users and SKUs grow with the
    business, so Spark picks by their size, and AQE splits a hot user or SKU.
    """
    joined = detail.join(users, "user_id", "left").join(skus, "sku_id", "left")
    as_text = {c: F.col(c).cast("string") for c in ("order_detail_id", "order_id", "user_id", "sku_id")}
    return joined.withColumns(as_text).select(*SALE_DETAIL_COLUMNS)


def matching_lines(detail: DataFrame, users: DataFrame, skus: DataFrame, keyword: str = "", level: int | None = None) -> DataFrame:
    """Order lines that a search finds, before any attribute is joined on.

    Only what the filters need is read: the SKUs that match the keyword and
    the users of the level, each as a semi join.
    """
    if keyword:
        detail = detail.join(skus.filter(match_text(F.col("sku_name"), keyword)).select("sku_id"), "sku_id", "left_semi")
    if level is not None:
        detail = detail.join(users.filter(F.col("user_level") == level).select("user_id"), "user_id", "left_semi")
    return detail


SALE_SORT = [(c, "asc") for c in SALE_DETAIL_COLUMNS]
_DAY_FIRST = [("dt", "asc"), *[s for s in SALE_SORT if s[0] != "dt"]]


def write_sale_detail(df: DataFrame, path: str, parts: int | None = None) -> None:
    """Table in ranges of day and grid order: a search reads the parts of its day, a page those that it lies in.

    ``parts`` is by default the session's number of shuffle partitions.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    write_ranged(df, path, _DAY_FIRST, parts)


def read_sale_detail(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """The sale columns and ``part``, of all days or of the parts of one."""
    rows = read_ranged(spark, path, date).select(*SALE_DETAIL_COLUMNS, PART)
    return rows if date is None else rows.filter(F.col("dt") == date)


def search_counts(found: DataFrame) -> DataFrame:
    """``part, age_name, gender_name, level, n``: rows by part, by age band, by gender, and all, from one aggregation.

    ``level`` is the grouping id of the set that a row belongs to: a bit is
    set for each column that the set leaves out, the first column's highest.
    """
    facts = found.select(PART, age_band(F.col("user_age")).alias("age_name"), gender_name(F.col("user_gender")).alias("gender_name"))
    sets = facts.groupingSets([[PART], ["age_name"], ["gender_name"], []], PART, "age_name", "gender_name")
    return sets.agg(F.grouping_id().alias("level"), F.count("*").alias("n"))


# Grouping ids of :func:`search_counts`.
BY_PART, BY_AGE, BY_GENDER, ALL = 0b011, 0b101, 0b110, 0b111


def sale_filter(date: str | None, keyword: str = "", level: int | None = None) -> Column:
    """Day equality; any word of the keyword in the SKU name unless empty; level if given."""
    keep = F.lit(True)
    if date is not None:
        keep = keep & (F.col("dt") == date)
    if keyword:
        keep = keep & match_text(F.col("sku_name"), keyword)
    if level is not None:
        keep = keep & (F.col("user_level") == level)
    return keep


def sale_detail_search(
    sales: DataFrame, date: str | None = DEFAULT_SALE_DATE, keyword: str = "", level: int | None = None
) -> DataFrame:
    """Rows of a search; without a date that of the dashboard is taken, ``None`` means all days."""
    return sales.filter(sale_filter(date, keyword, level))


def sale_detail_page(found: DataFrame, page: int, size: int) -> DataFrame:
    """One grid page.  Line ids need not be unique, so all columns settle the order."""
    return paginate(found, SALE_SORT, page, size)


def page_of_lines(lines: DataFrame, users: DataFrame, skus: DataFrame, page: int, size: int) -> DataFrame:
    """The same page, cut from the order lines; users and SKUs are joined to its rows only.

    A user and a SKU have one row each, so lines that agree in both keys agree
    in the attributes too and these settle nothing.
    """
    text = lambda c: F.col(c).cast("string") if c.endswith("_id") else F.col(c)
    own = [c for c in SALE_DETAIL_COLUMNS if c in lines.columns]
    cut = lines.orderBy(*[text(c).asc_nulls_last() for c in own]).offset((page - 1) * size).limit(size)
    # Put in order as one sorted list: AQE has been seen to drop a sort above the joins of a limited frame.
    nulls_last = [F.struct(F.col(c).isNull(), F.col(c)) for c in SALE_DETAIL_COLUMNS]
    row = F.struct(F.struct(*nulls_last).alias("at"), F.struct(*SALE_DETAIL_COLUMNS).alias("row"))
    listed = build_sale_detail(cut, users, skus).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return listed.select(F.inline(F.transform("rows", lambda x: x["row"])))


def sale_detail_total(found: DataFrame) -> DataFrame:
    return found.agg(F.count("*").alias("total"))


def user_groups(lines: DataFrame, users: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """``age_name, gender_name, n``: lines by age band and gender, a dozen rows at most.

    ``weight`` names a column of line counts; without it a row is one line.
    With ``users`` given, lines are counted per user before the join, so a
    user with a third of the lines joins as one row.
    """
    n = F.sum(weight) if weight else F.count("*")
    if users is not None:
        per_user = lines.groupBy("user_id").agg(n.alias("n"))
        lines = per_user.join(users.select("user_id", "user_gender", "user_age"), "user_id", "left")
        n = F.sum("n")
    return lines.groupBy(
        age_band(F.col("user_age")).alias("age_name"), gender_name(F.col("user_gender")).alias("gender_name")
    ).agg(n.alias("n"))


def _facet(groups: DataFrame, facet: str, name: str) -> DataFrame:
    known = groups.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("name"))
    rows = with_pct(known.agg(F.sum("n").alias("value")))
    return rows.select(F.lit(facet).alias("facet"), "name", "value", "pct")


def age_facet(groups: DataFrame) -> DataFrame:
    """``facet, name, value, pct`` by age band of :func:`user_groups`; unknown ages are left out."""
    return _facet(groups, "age", "age_name")


def gender_facet(groups: DataFrame) -> DataFrame:
    return _facet(groups, "gender", "gender_name")


def sum_by_dimension(
    facts: DataFrame, key: str, value: str, dimension: DataFrame, group: str
) -> DataFrame:
    """Sum of ``value`` by a dimension attribute.

    Summed per key first: the join then sees one row per key however hot the
    key is, and the dimension is never broadcast unless Spark finds it small.
    """
    per_key = facts.groupBy(key).agg(F.sum(value).alias(value))
    return (
        per_key.join(dimension.select(key, group), key, "left").groupBy(group).agg(F.sum(value).alias(value))
    )


def region_sales(
    sales: DataFrame,
    users: DataFrame,
    regions: DataFrame,
    splits: tuple[float, ...] = REGION_SPLITS,
    unit: float = 1.0,
) -> DataFrame:
    """``name, value, bin``: sales by region, in ``unit``s, and the colour band they fall in.

    ``sales``: user_id, value; ``users``: user_id, region_id; ``regions``:
    region_id, name.
    """
    per_region = sum_by_dimension(sales, "user_id", "value", users, "region_id")
    named = per_region.join(regions.select("region_id", "name"), "region_id")
    value = F.col("value").cast("double") / F.lit(unit)
    return named.select("name", value.alias("value"), bin_values(value, splits).alias("bin"))


def category_sales(sales: DataFrame, skus: DataFrame) -> DataFrame:
    """``name, num``: sales by category.  ``sales``: sku_id, num; ``skus``: sku_id, category."""
    per_category = sum_by_dimension(sales, "sku_id", "num", skus, "category")
    # Summed exactly, cut to whole units once.
    return per_category.select(F.col("category").alias("name"), F.round("num").cast("long").alias("num"))
