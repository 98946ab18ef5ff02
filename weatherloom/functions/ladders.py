"""Table-driven ``when`` ladders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from weatherloom import fixed_values as V


def _ladder(rungs: Iterable[tuple[Column, object]], otherwise: Column) -> Column:
    out = None
    for condition, label in rungs:
        out = F.when(condition, F.lit(label)) if out is None else out.when(condition, F.lit(label))
    return otherwise if out is None else out.otherwise(otherwise)


def above(value: Column, steps, otherwise: str) -> Column:
    """The first label whose bound lies strictly below ``value``."""
    return _ladder(((value > bound, label) for bound, label in steps), F.lit(otherwise))


def at_least(value: Column, steps, otherwise: str) -> Column:
    """The first label whose bound is reached by ``value``."""
    return _ladder(((value >= bound, label) for bound, label in steps), F.lit(otherwise))


def at_most(value: Column, steps, otherwise: str) -> Column:
    """The first label whose bound is not exceeded by ``value``."""
    return _ladder(((value <= bound, label) for bound, label in steps), F.lit(otherwise))


def air_quality_five(pm25: Column) -> Column:
    """Five bands, for a reading or for an average; a missing value counts as good air."""
    return above(pm25, V.AIR_QUALITY_FIVE, V.AIR_QUALITY_FIVE_ELSE)


def air_quality_four(pm25_avg: Column) -> Column:
    """Four bands on an average."""
    return at_most(pm25_avg, V.AIR_QUALITY_FOUR, V.AIR_QUALITY_FOUR_ELSE)


def system_status(high_quality_percent: Column) -> Column:
    return at_least(high_quality_percent, V.SYSTEM_STATUS, V.SYSTEM_STATUS_ELSE)


def dashboard_band(value: Column, metric: str) -> Column:
    """Colour band of a dashboard tile; NULL stays NULL."""
    lowest, steps = V.DASHBOARD_BANDS[metric]
    return F.when(value.isNotNull(), at_least(value, tuple(reversed(steps)), lowest))
