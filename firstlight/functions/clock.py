"""Event-time columns: day, hour and minute of an epoch-millisecond stamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# First and last millisecond of the years 1 to 9999.
TS_MIN = -62135596800000
TS_MAX = 253402300799999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wall_clock(ts: Column | str, tz: str = "UTC") -> Column:
    """Local wall-clock time in ``tz`` of an epoch-ms column.

    Independent of the session zone.  Stamps outside the years 1-9999 give
    NULL instead of an overflow error.
    """
    ts = _col(ts)
    utc = F.timestamp_add("MILLISECOND", ts, F.expr(EPOCH))
    local = utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    return F.when(ts.between(TS_MIN, TS_MAX), local)


def epoch_ms(ts_ntz: Column | str) -> Column:
    """Epoch milliseconds of a zone-less timestamp read as UTC."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH), _col(ts_ntz).cast("timestamp_ntz"))


def day(ts: Column | str, tz: str = "UTC") -> Column:
    """The day as DATE: a 4-byte grouping key; cast to string only in results."""
    return wall_clock(ts, tz).cast("date")


def two_digits(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def hour_text(ts: Column | str, tz: str = "UTC") -> Column:
    """Zero-padded hour ``00`` to ``23``."""
    return two_digits(F.hour(wall_clock(ts, tz)))


def minute_text(ts: Column | str, tz: str = "UTC") -> Column:
    return two_digits(F.minute(wall_clock(ts, tz)))


def with_dt_hr(df: DataFrame, ts: str = "ts", tz: str = "UTC") -> DataFrame:
    """Add ``dt`` (yyyy-MM-dd) and ``hr`` (HH) of an epoch-ms column."""
    return df.withColumns({"dt": day(ts, tz).cast("string"), "hr": hour_text(ts, tz)})


def previous_day(dt: Column | str) -> Column:
    """The day before a yyyy-MM-dd text; a plain string is taken as a literal."""
    dt = F.lit(dt) if isinstance(dt, str) else dt
    return F.date_sub(F.to_date(dt), 1).cast("string")


def today_text() -> Column:
    """Today in the session zone, as yyyy-MM-dd."""
    return F.current_date().cast("string")
