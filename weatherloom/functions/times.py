"""Time helpers. The clock is always a parameter; None means now."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom import fixed_values as V


# fixed values: ISO text that keeps microseconds; writers cut them off by default
ISO_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def moment(as_of: Column | datetime | str | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def newest(df: DataFrame, column: str = "timestamp") -> Column:
    """The latest value of a column, as a one-row subquery."""
    return df.agg(F.max(column)).scalar()


def before(as_of: Column, interval: str) -> Column:
    return as_of - F.expr(f"INTERVAL {interval}")


def parsed_timestamp(text: Column) -> Column:
    """ISO text with or without zone; unreadable text becomes NULL."""
    return F.try_to_timestamp(text)


def batch_stamp(at: Column) -> Column:
    return F.concat(F.lit(V.BATCH_PREFIX), F.date_format(at, V.BATCH_TIME_FORMAT))


def month_key(at: Column) -> Column:
    return F.date_format(at, V.MONTH_FORMAT)


def time_parts(at: Column) -> dict[str, Column]:
    return {"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at), "hour": F.hour(at)}
