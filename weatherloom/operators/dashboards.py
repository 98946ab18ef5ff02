"""Dashboard panels over the table of streamed readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom.functions import ladders
from weatherloom.operators import latest

ROUNDED = ("temperature", "humidity", "pressure", "pm25")


def _rounded(c: str) -> Column:
    return F.round(c, 1) if c in ROUNDED else F.col(c)


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def latest_values(df: DataFrame) -> DataFrame:
    """The newest reading's five values; one pass serves all five tiles."""
    one = latest.newest_rows(df.select("id", "inserted_at", *ROUNDED, "light"), 1)
    return one.select(*[_rounded(c).alias(c) for c in (*ROUNDED, "light")])


def with_bands(df: DataFrame, metrics=("temperature", "humidity", "pressure", "light", "pm25")) -> DataFrame:
    """Add the colour band of each metric."""
    return df.withColumns({f"{m}_band": ladders.dashboard_band(F.col(m), m) for m in metrics})


def series(df: DataFrame, metric: str, n: int = 100) -> DataFrame:
    """The newest ``n`` points of one metric."""
    points = latest.newest_rows(df.select("id", "inserted_at", metric), n)
    return points.select(F.col("inserted_at").alias("time"), metric)


def all_series(df: DataFrame, n: int = 100) -> DataFrame:
    """The five metric series at once: they share their newest ``n`` instants."""
    points = latest.newest_rows(df.select("id", "inserted_at", *ROUNDED, "light"), n)
    return points.select("id", F.col("inserted_at").alias("time"), *ROUNDED, "light")


def newest_table(df: DataFrame, n: int = 15) -> DataFrame:
    """The newest ``n`` readings under their panel headings."""
    names = V.DASHBOARD_COLUMN_NAMES
    rows = latest.newest_rows(df.select("id", *names), n)
    return rows.select(*[_rounded(c).alias(name) for c, name in names.items()])


def newest_sample(df: DataFrame, n: int = 5) -> DataFrame:
    """The newest ``n`` readings as a loading check prints them."""
    rows = latest.newest_rows(df.select("id", "sensor_id", *ROUNDED[:3], "inserted_at"), n)
    return rows.select("sensor_id", *[_rounded(c).alias(c) for c in ROUNDED[:3]], "inserted_at")


def gauges(df: DataFrame) -> DataFrame:
    """The four gauge means in one pass."""
    return df.agg(*[F.round(F.avg(c), 1).alias(c) for c in ROUNDED])


def extremes(df: DataFrame) -> DataFrame:
    """Lowest, mean and highest value of three metrics, one row each, from one pass."""
    shown = dict(zip(V.DASHBOARD_EXTREMES, (F.min, F.avg, F.max), strict=True))
    metrics = V.DASHBOARD_METRIC_NAMES
    one = df.agg(*[f(c).alias(f"{c}_{name}") for c in metrics for name, f in shown.items()])
    rows = [
        F.struct(
            F.lit(label).alias(V.DASHBOARD_METRIC),
            *[F.round(f"{c}_{name}", 1).alias(name) for name in shown],
        )
        for c, label in metrics.items()
    ]
    return one.select(F.inline(F.array(*rows)))
