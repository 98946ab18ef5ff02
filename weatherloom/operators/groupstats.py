"""Attach statistics to rows: global ones, and per-key ones whatever the number or size of the keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.session import cut_lineage

BROADCAST_KEYS = 200_000


def with_global(df: DataFrame, name: str, *statistics: Column) -> DataFrame:
    """Add one struct column of statistics over all rows.

    The statistics are a one-row subquery: one aggregate pass, whose result is a
    constant for every row. There is no join and no trip through the driver.
    """
    return df.withColumn(name, df.agg(F.struct(*statistics)).scalar())


def attach(
    df: DataFrame,
    stats: DataFrame,
    key: str = "sensor_id",
    weight: str = "readings",
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """Left join ``df`` with one row per key from ``stats``.

    ``stats`` holds the row count of each key in ``weight``; that column is not
    passed on. The statistics are written once to the shared folder. Keys holding
    more than one ``broadcast_keys``-th of all rows are broadcast: there can be no
    more than ``broadcast_keys`` of them, and every heavy key is among them. The
    rows of the other keys take an ordinary join, which cannot be skewed and
    for which the planner chooses by the size in bytes of what was
    written: a small table is broadcast, so that no row moves. Rows without a
    key take no part in it. The plan is the same for any number of keys.
    """
    stats = cut_lineage(stats)
    values = [c for c in stats.columns if c not in (key, weight)]
    total = stats.agg(F.sum(weight)).scalar()
    is_heavy = F.col(weight) * broadcast_keys > total
    heavy = stats.filter(is_heavy).withColumn("_heavy", F.lit(True)).drop(weight)
    light = stats.filter(~is_heavy).drop(weight)

    marked = df.join(F.broadcast(heavy), key, "left")
    in_place = F.col("_heavy").isNotNull() | F.col(key).isNull()
    kept = marked.filter(in_place).drop("_heavy")
    moved = marked.filter(~in_place).drop("_heavy", *values).join(light, key, "left")
    return kept.unionByName(moved)
