"""Duplicate removal. Copies collapse inside each task before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weatherloom import fixed_values as V


def exact(df: DataFrame) -> DataFrame:
    """One row for each set of fully identical rows.

    A hash aggregate over all columns: a value repeated across a third of the
    table leaves each map task once.
    """
    return df.dropDuplicates()


def any_per_key(df: DataFrame, keys=V.READING_KEY) -> DataFrame:
    """One row per key, whichever comes first."""
    return df.dropDuplicates(list(keys))


def last_per_key(
    df: DataFrame, keys=V.READING_KEY, order=("ingestion_timestamp", "id")
) -> DataFrame:
    """The row of each key that is greatest in ``order``.

    The rank filter is planned as a group limit below the shuffle, so each map
    task passes on at most one row per key however many copies it holds.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") == 1).drop("_rank")
    )


def with_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of times each occurred."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
