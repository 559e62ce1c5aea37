"""Daily-active metrics.

Input is a frame of launches with ``dt`` (yyyy-MM-dd text or DATE), ``mid``
and ``hr`` (HH text or INT); it may hold repeats, or several stored versions
of a record.  Inside, days are DATE and hours INT so that every aggregate is a
hash aggregate over fixed-width buffers; texts are made for the result only.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firstlight.functions.clock import day, previous_day, two_digits, wall_clock
from firstlight.functions.labels import KPI_NAMES


def launches(logs: DataFrame, tz: str = "UTC") -> DataFrame:
    """``dt DATE, mid, hr INT`` of logs with ``mid`` and ``ts``."""
    return logs.select(day("ts", tz).alias("dt"), "mid", F.hour(wall_clock("ts", tz)).alias("hr"))


def _day_text() -> Column:
    return F.col("dt").cast("string").alias("dt")


def _first_hours(launched: DataFrame) -> DataFrame:
    """A device counts in its first hour of the day only."""
    return launched.groupBy("dt", "mid").agg(F.min(F.col("hr").cast("int")).alias("hr"))


def dau_total(launched: DataFrame, date: str | None = None) -> DataFrame:
    """``dt, n``: distinct devices of every day; of one day, with 0 when it has none, if given."""
    if date is None:
        return launched.groupBy("dt").agg(F.count_distinct("mid").alias("n")).select(_day_text(), "n")
    one = launched.filter(F.col("dt") == date).agg(F.count_distinct("mid").alias("n"))
    return one.select(F.lit(date).alias("dt"), "n")


def dau_hour(launched: DataFrame, date: str | None = None) -> DataFrame:
    """``dt, hr, n``: devices by their first hour of the day."""
    if date is not None:
        launched = launched.filter(F.col("dt") == date)
    counts = _first_hours(launched).groupBy("dt", "hr").agg(F.count("*").alias("n"))
    return counts.select(_day_text(), two_digits(F.col("hr")).alias("hr"), "n")


def hour_spine(counts: DataFrame, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """All 24 hours for every group, missing counts as 0.

    Each group's counts (24 at most) become one map that the hours are looked
    up in: no join.  Without ``by`` the result has 24 rows even for no input.
    """
    packed = F.map_from_entries(F.collect_list(F.struct("hr", F.struct(*values))))
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), two_digits)
    spine = counts.groupBy(*by).agg(packed.alias("_m")).select(*by, "_m", F.explode(hours).alias("hr"))
    found = F.try_element_at("_m", "hr")
    return spine.select(*by, "hr", *[F.coalesce(found[v], F.lit(0)).alias(v) for v in values])


def hourly_compare(launched: DataFrame, date: str) -> DataFrame:
    """``hr, today_n, yesterday_n`` for all 24 hours.  One scan of two days."""
    yesterday = previous_day(date)
    hours = _first_hours(launched.filter((F.col("dt") == date) | (F.col("dt") == yesterday)))
    counts = hours.groupBy(two_digits(F.col("hr")).alias("hr")).agg(
        F.count_if(F.col("dt") == date).alias("today_n"),
        F.count_if(F.col("dt") == yesterday).alias("yesterday_n"),
    )
    return hour_spine(counts, ["today_n", "yesterday_n"])


def compare_hours(hours: DataFrame, date: str) -> DataFrame:
    """As :func:`hourly_compare`, from hour counts ``dt, hr, n`` that are kept up to date."""
    yesterday = previous_day(date)
    two = hours.filter((F.col("dt") == date) | (F.col("dt") == yesterday))
    of = lambda day: F.coalesce(F.sum(F.when(F.col("dt") == day, F.col("n"))), F.lit(0))
    counts = two.groupBy("hr").agg(of(date).alias("today_n"), of(yesterday).alias("yesterday_n"))
    return hour_spine(counts, ["today_n", "yesterday_n"])


def kpi_of_sums(hours: DataFrame, new: DataFrame, date: str) -> DataFrame:
    """As :func:`kpi_totals`, from hour counts and counts of new devices ``dt, n`` that are kept up to date.

    Every device of a day stands in one hour, so the hours add up to the day.
    """
    none = F.lit(0).cast("long")
    today = hours.filter(F.col("dt") == date).select(F.col("n").alias("dau"), none.alias("new_mid"))
    first = new.filter(F.col("dt") == date).select(none.alias("dau"), F.col("n").alias("new_mid"))
    return kpi_rows(today.unionByName(first).agg(F.sum("dau").alias("dau"), F.sum("new_mid").alias("new_mid")))


def dau_cumulative(hours: DataFrame) -> DataFrame:
    """``dt, hr, n, total_n``: running total of each day's hour counts, on all 24 hours."""
    w = Window.partitionBy("dt").orderBy("hr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hour_spine(hours, ["n"], by=["dt"]).withColumn("total_n", F.sum("n").over(w))


def terms_agg(df: DataFrame, field: str, size: int) -> DataFrame:
    """``field, n``: the ``size`` most frequent values, exact; ties by value."""
    return (
        df.groupBy(field).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(field)).limit(size)
    )


def first_days(launched: DataFrame) -> DataFrame:
    """``mid, dt DATE``: the day every device was first seen."""
    return launched.groupBy("mid").agg(F.min(F.to_date("dt")).alias("dt"))


def new_devices(launched: DataFrame) -> DataFrame:
    """``dt, n``: devices by the day they were first seen."""
    return first_days(launched).groupBy("dt").agg(F.count("*").alias("n")).select(_day_text(), "n")


def kpi_rows(values: DataFrame) -> DataFrame:
    """One row of KPI columns to ``id, name, value`` rows."""
    kpis = F.array(
        *[
            F.struct(F.lit(i).alias("id"), F.lit(n).alias("name"), F.coalesce(F.col(i), F.lit(0)).alias("value"))
            for i, n in KPI_NAMES.items()
        ]
    )
    return values.select(F.inline(kpis))


def kpi_totals(launched: DataFrame, date: str, first_seen: DataFrame | None = None) -> DataFrame:
    """``id, name, value``: devices of the day and devices seen for the first time.

    Without a ``first_seen`` table one aggregate over the history up to the
    day gives both; with it only that day's partitions are read.
    """
    if first_seen is None:
        seen = launched.filter(F.col("dt") <= date).groupBy("mid").agg(
            F.min(F.to_date("dt")).alias("first_dt"), F.max(F.col("dt") == date).alias("today")
        )
        return kpi_rows(
            seen.agg(
                F.count_if("today").alias("dau"), F.count_if(F.col("first_dt") == date).alias("new_mid")
            )
        )
    today = dau_total(launched, date).select(F.col("n").alias("dau"), F.lit(0).cast("long").alias("new_mid"))
    new = first_seen.filter(F.col("dt") == date).agg(F.count("*").alias("new_mid"))
    both = today.unionByName(new.select(F.lit(0).cast("long").alias("dau"), "new_mid"))
    return kpi_rows(both.agg(F.sum("dau").alias("dau"), F.sum("new_mid").alias("new_mid")))


def launch_count(launched: DataFrame) -> DataFrame:
    """``dt, n``: every launch, repeats included."""
    return launched.groupBy("dt").agg(F.count("*").alias("n")).select(_day_text(), "n")


def daily_kpis(launched: DataFrame) -> DataFrame:
    """``dt DATE, dau, launches, new_mid`` of every day, from one scan.

    Launches are counted per device and day first; what follows sees one row
    per device and day, however many launches a device has.
    """
    per_day = launched.groupBy("mid", F.to_date("dt").alias("dt")).agg(F.count("*").alias("n"))
    first = F.min("dt").over(Window.partitionBy("mid"))
    return (
        per_day.withColumn("first_dt", first)
        .groupBy("dt")
        .agg(
            F.count("*").alias("dau"),
            F.sum("n").alias("launches"),
            F.count_if(F.col("dt") == F.col("first_dt")).alias("new_mid"),
        )
    )


def kpi_series(daily: DataFrame) -> DataFrame:
    """One row per day with a column per KPI to rows ``id, dt, value``."""
    kpis = [c for c in daily.columns if c != "dt"]
    entries = F.array(*[F.struct(F.lit(k).alias("id"), F.col(k).alias("value")) for k in kpis])
    return daily.select("dt", F.inline(entries)).select("id", "dt", "value")


def kpi_day_over_day(daily: DataFrame) -> DataFrame:
    """``id, dt, value, previous, change_pct`` of rows ``id, dt, value``.

    Days without a row between a KPI's first and last day count as 0.  The
    change is NULL on the first day and after a day of 0.
    """
    w = Window.partitionBy("id").orderBy("dt")
    daily = daily.select("id", F.to_date("dt").alias("_dt"), "value").withColumnRenamed("_dt", "dt")
    # Each row also stands for the empty days up to the next row.
    until = F.coalesce(F.date_sub(F.lead("dt").over(w), 1), F.col("dt"))
    dense = daily.withColumn("until", until).select(
        "id", F.explode(F.sequence("dt", "until")).alias("day"), F.col("dt").alias("real"), "value"
    )
    value = F.when(F.col("day") == F.col("real"), F.col("value")).otherwise(F.lit(0))
    rows = dense.select("id", F.col("day").alias("dt"), value.alias("value"))
    rows = rows.withColumn("previous", F.lag("value").over(w))
    change = F.try_divide((F.col("value") - F.col("previous")) * F.lit(100.0), F.col("previous"))
    return rows.select("id", _day_text(), "value", "previous", change.alias("change_pct"))


def with_pct(df: DataFrame, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """Add ``pct``, the share of the group's total; meant for small result frames."""
    total = F.sum(value).over(Window.partitionBy(*by))
    return df.withColumn("pct", F.try_divide(F.col(value) * F.lit(100.0), total))
