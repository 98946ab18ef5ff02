"""Unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def by_position(*frames: DataFrame) -> DataFrame:
    """Stack frames by column position; their types must agree."""
    types = {tuple(f.dataType for f in frame.schema.fields) for frame in frames}
    if len(types) > 1:
        raise ValueError("frames to stack by position must have the same column types")
    return reduce(DataFrame.union, frames)
