"""The three cleaning chains. The order of their steps is part of their meaning.

Each chain first removes duplicates and then passes over the distinct readings
several times, for statistics and for the rows. With ``stage``, a path in the
lake, the distinct readings are written there once: the later passes read only
the columns they need instead of shuffling whole rows again. Without it the
chain is one lazy plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from weatherloom import schemas
from weatherloom.operators import duplicates, filters, impute, project
from weatherloom.sinks import lake


def _settled(df: DataFrame, stage: str | None) -> DataFrame:
    return df if stage is None else lake.staged(df, stage)


def by_range(df: DataFrame, nulls: str = "drop", stage: str | None = None) -> DataFrame:
    """One reading per key, physical ranges, medians, unknown locations, derived measures.

    Of several readings with one key the newest stays: an arbitrary choice
    could differ when a lost task is run again. The quality score is taken
    before imputation, so that it tells what was measured. With ``nulls="drop"``
    no reading has a gap and there is nothing to impute.
    """
    scored = (
        _settled(duplicates.last_per_key(df), stage)
        .transform(filters.present, "sensor_id", "timestamp")
        .transform(filters.valid_range, nulls)
        .transform(project.quality_score)
    )
    whole = scored.transform(impute.median_global) if nulls == "keep" else scored
    return whole.transform(impute.unknown_location).transform(project.derived_measures)


def by_sigma(df: DataFrame, stage: str | None = None) -> DataFrame:
    """Identical rows, five sample deviations of temperature, means."""
    return _settled(duplicates.exact(df), stage).transform(filters.sigma).transform(impute.mean_global)


def by_sigma_with_times(df: DataFrame, stage: str | None = None) -> DataFrame:
    """Identical rows, required values, five population deviations, means, time parts."""
    return (
        _settled(duplicates.exact(schemas.with_sensor_id(df)), stage)
        .transform(filters.present, "sensor_id", "temperature")
        .transform(filters.sigma, population=True)
        .transform(impute.mean_global, skip_zero=True)
        .transform(project.time_parts)
    )
