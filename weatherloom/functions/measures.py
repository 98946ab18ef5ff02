"""Derived measures of one reading."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weatherloom import fixed_values as V


def fahrenheit(celsius: Column) -> Column:
    return celsius * V.FAHRENHEIT_SCALE + V.FAHRENHEIT_OFFSET


def _outside(value: Column, limits: tuple[float, float]) -> Column:
    low, high = limits
    return (value < low) | (value > high)


def comfort_index(temperature: Column, humidity: Column) -> Column:
    """Comfortable inside both comfort ranges, uncomfortable outside a tolerable one."""
    good, bad, fair = V.COMFORT_LABELS
    comfortable = temperature.between(*V.COMFORT_TEMPERATURE) & humidity.between(*V.COMFORT_HUMIDITY)
    harsh = _outside(temperature, V.TOLERABLE_TEMPERATURE) | _outside(humidity, V.TOLERABLE_HUMIDITY)
    return F.when(comfortable, good).when(harsh, bad).otherwise(fair)


def quality_score(temperature: Column, humidity: Column, pressure: Column) -> Column:
    """How much of a reading is present; take it before imputation."""
    full, no_pressure, only_temperature, poor = V.QUALITY_SCORES
    return (
        F.when(temperature.isNull(), poor)
        .when(humidity.isNull(), only_temperature)
        .when(pressure.isNull(), no_pressure)
        .otherwise(full)
    )


def sensor_category(sensor_id: Column) -> Column:
    category = F.lit(V.OTHER_CATEGORY)
    for prefix, label in V.SENSOR_CATEGORIES.items():
        category = F.when(sensor_id.startswith(prefix), label).otherwise(category)
    return category


def sensor_name(sensor_id: Column) -> Column:
    return F.concat(F.lit(V.SENSOR_NAME_PREFIX), F.right(sensor_id, F.lit(2)))
