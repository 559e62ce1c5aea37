import json

from pyspark.sql import types as T

from firstlight.schemas import DAU_INFO


def log(mid="m1", ts=0, uid=None, ar=None, ch=None, vc=None, **extra):
    """One raw log body."""
    common = {k: v for k, v in dict(mid=mid, uid=uid, ar=ar, ch=ch, vc=vc).items() if v is not None}
    return json.dumps({"common": common, "ts": ts, **extra})


def raw(spark, bodies, offsets=True):
    rows = [(b, "start_log", i % 2, i if offsets else None) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "value string, topic string, partition int, offset long")


def records(spark, rows):
    """Rows of mid, ts, ch to activity records of UTC days."""
    from firstlight.operators.ingest import to_dau_info

    df = spark.createDataFrame(rows, "mid string, ts long, ch string")
    return to_dau_info(df.selectExpr("*", "'u' uid", "'a' ar", "'v' vc"))


def ms(text):
    """Epoch ms of a UTC time 'yyyy-MM-dd HH:mm[:ss[.fff]]'."""
    from datetime import datetime, timezone

    return round(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def rows(df, *columns):
    df = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in df.collect())


__all__ = ["DAU_INFO", "T", "log", "ms", "raw", "records", "rows"]
