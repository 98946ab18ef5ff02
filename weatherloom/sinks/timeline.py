"""The append-only table behind the dashboards.

Partitioned by the month of arrival and ordered by arrival and sensor inside
each file, so that time filters prune folders and row groups. Rows that jobs append
lie below ``appended``; rows of streams are an epoch table, which :func:`compact` keeps
from growing in files.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.functions import times
from weatherloom.sinks import storage
from weatherloom.sinks.epochs import EpochTable

MONTH = "inserted_month"
REJECTED = "rejected"
#: Columns of a stream's rows besides the reading: whether the message was rejected, its text if so, the stream.
STREAM_COLUMNS = (REJECTED, "message", "source_stream")
ORDER = ("inserted_at", "sensor_id")


def arrived(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Stamp the arrival time unless the rows carry one."""
    return df if "inserted_at" in df.columns else df.withColumn("inserted_at", times.moment(at))


def _dated(df: DataFrame) -> DataFrame:
    return arrived(df).withColumn(MONTH, times.month_key(F.col("inserted_at")))


def appended(path: str) -> str:
    return f"{path}/appended"


def streamed(path: str) -> EpochTable:
    return EpochTable(path, MONTH, "int", ORDER)


def append(df: DataFrame, path: str) -> None:
    # sorting by the partition column first spares the writer a sort of its own
    _dated(df).sortWithinPartitions(MONTH, *ORDER).write.mode("append").partitionBy(MONTH).parquet(appended(path))


def backfill(df: DataFrame, path: str) -> None:
    """Append many months at once: rows are gathered by month first.

    Rebalancing splits a month that is too big for one task and joins small
    ones, so the number of files follows the data and not tasks times months.
    """
    append(_dated(df).hint("rebalance", MONTH).drop(MONTH), path)


def write_epoch(df: DataFrame, path: str, stream: str, epoch: int) -> None:
    """Store one micro-batch of a stream.

    A micro-batch that is delivered again replaces exactly what its first
    delivery wrote, whichever months that touched.
    """
    streamed(path).write(_dated(df), stream, epoch)


def compact(spark: SparkSession, path: str, all_epochs: bool = False) -> int:
    """Write the micro-batches of the streams into few files a month; how many were taken in."""
    return streamed(path).compact(spark, all_epochs)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """Every row, with what a stream has rejected."""
    parts = [spark.read.parquet(appended(path))] if storage.exists(spark, appended(path)) else []
    rows = streamed(path).read(spark)
    parts += [] if rows is None else [rows]
    if not parts:
        raise ValueError(f"no rows at {path}")
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The readings."""
    rows = stored(spark, path)
    # rows appended by jobs have no such column
    return rows.filter(~F.coalesce(F.col(REJECTED), F.lit(False))).drop(*STREAM_COLUMNS) if REJECTED in rows.columns else rows
