"""Row filters: required values, valid ranges, outliers, increments and intervals."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom.functions import times
from weatherloom.operators import groupstats


def present(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def valid_range(df: DataFrame, nulls: str = "drop") -> DataFrame:
    """Keep readings inside the physical ranges, bounds included.

    ``nulls="drop"`` also removes readings that lack one of the values;
    ``nulls="keep"`` leaves them for imputation.
    """
    if nulls not in ("drop", "keep"):
        raise ValueError("nulls must be 'drop' or 'keep'")
    inside = [(F.col(c), F.col(c).between(*limits)) for c, limits in V.VALID_RANGES.items()]
    if nulls == "keep":
        return df.filter(reduce(and_, [value.isNull() | ok for value, ok in inside]))
    return df.filter(reduce(and_, [ok for _, ok in inside]))


def sigma_bounds(column: str, sigmas: float, population: bool = False) -> list[Column]:
    """Aggregates for the lower and upper bound; NULL where there is no spread."""
    spread = F.stddev_pop(column) if population else F.stddev_samp(column)
    centre = F.avg(column)
    return [
        F.when(spread > 0, centre - sigmas * spread).alias("lower"),
        F.when(spread > 0, centre + sigmas * spread).alias("upper"),
    ]


def within_bounds(value: Column, bounds: Column) -> Column:
    """True inside the bounds, and for every row when there are no bounds.

    A missing value lies outside any existing bounds.
    """
    return F.coalesce(value.between(bounds["lower"], bounds["upper"]), bounds["lower"].isNull())


def sigma(
    df: DataFrame,
    column: str = "temperature",
    sigmas: float = V.OUTLIER_SIGMAS,
    population: bool = False,
) -> DataFrame:
    """Drop rows further than ``sigmas`` deviations from the mean."""
    bounded = groupstats.with_global(df, "_bounds", *sigma_bounds(column, sigmas, population))
    return bounded.filter(within_bounds(F.col(column), F.col("_bounds"))).drop("_bounds")


def id_after(df: DataFrame, last_id, id_column: str = "id", up_to=None) -> DataFrame:
    """Rows above a mark and, if given, up to a fixed end, so that a retry sees the same rows."""
    rows = df.filter(F.col(id_column) > last_id)
    return rows if up_to is None else rows.filter(F.col(id_column) <= up_to)


def time_after(df: DataFrame, last, column: str = "timestamp") -> DataFrame:
    return df.filter(F.col(column) > last)


def last_interval(
    df: DataFrame, as_of=None, interval: str = "10 MINUTES", column: str = "timestamp"
) -> DataFrame:
    """Readings of the last interval before ``as_of``, newest first."""
    since = times.before(times.moment(as_of), interval)
    return df.filter(F.col(column) > since).orderBy(F.desc(column), F.desc("id"))


def pm25_alert(df: DataFrame, limit: float = V.HIGH_PM25) -> DataFrame:
    return df.filter(F.col("pm25") > limit)


def pm25_alert_newest_first(df: DataFrame, limit: float = V.HIGH_PM25) -> DataFrame:
    return pm25_alert(df, limit).orderBy(F.desc("timestamp"), F.desc("id"))


def first_retained(as_of: Column, days: int = V.RETENTION_DAYS) -> Column:
    """The oldest day that is kept."""
    return F.date_sub(as_of, days)


def retained(
    df: DataFrame, as_of: Column, days: int = V.RETENTION_DAYS, date_column: str = "ingest_date"
) -> DataFrame:
    """Rows of the last ``days`` days; on a table partitioned by the date this prunes partitions."""
    return df.filter(F.col(date_column) >= first_retained(as_of, days))
