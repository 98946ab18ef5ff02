"""Per-sensor and per-location reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom.operators import groupstats


def statistics(df: DataFrame) -> DataFrame:
    """Readings, temperature mean and extremes, mean humidity of each sensor."""
    wanted = {
        "temp_avg": ("temperature", F.avg),
        "temp_max": ("temperature", F.max),
        "temp_min": ("temperature", F.min),
        "humidity_avg": ("humidity", F.avg),
    }
    return df.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("readings_count"),
        *[f(c).alias(name) for name, (c, f) in wanted.items() if c in df.columns],
    )


def statistics_of_parts(held: DataFrame) -> DataFrame:
    """The same statistics from :func:`kpis.parts`."""
    return held.groupBy("sensor_id").agg(
        F.sum("readings").alias("readings_count"),
        F.try_divide(F.sum("sum_temperature"), F.sum("n_temperature")).alias("temp_avg"),
        F.max("max_temperature").alias("temp_max"),
        F.min("min_temperature").alias("temp_min"),
        F.try_divide(F.sum("sum_humidity"), F.sum("n_humidity")).alias("humidity_avg"),
    )


def statistics_ranked(df: DataFrame) -> DataFrame:
    """The same, busiest sensor first."""
    return statistics(df).orderBy(F.desc("readings_count"), "sensor_id")


def averages(df: DataFrame) -> DataFrame:
    """Readings and mean temperature and humidity of each sensor."""
    return df.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.avg(c).alias(label) for c, label in V.SENSOR_MEAN_NAMES.items()],
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(100.0 * part, whole)


def quality(df: DataFrame) -> DataFrame:
    """Mean quality score and completeness of each sensor."""
    return df.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("readings"),
        F.avg("data_quality_score").alias("avg_quality"),
        *[
            _percent(F.count(c), F.count(F.lit(1))).alias(f"completeness_{c}")
            for c in V.MEDIAN_IMPUTED_COLUMNS
        ],
    )


def location_comfort(df: DataFrame) -> DataFrame:
    """Climate, comfort distribution and number of sensors of each location."""
    comfort = F.col("comfort_index")
    return df.groupBy("location").agg(
        F.count_distinct("sensor_id").alias("sensors"),
        *[F.avg(c).alias(f"avg_{c}") for c in V.MEDIAN_IMPUTED_COLUMNS],
        *[F.count_if(comfort == label).alias(label.lower()) for label in V.COMFORT_LABELS],
    )


def anomaly_flags(
    df: DataFrame,
    column: str = "temperature",
    sigmas: float = V.ANOMALY_SIGMAS,
    broadcast_keys: int = groupstats.BROADCAST_KEYS,
) -> DataFrame:
    """Mark readings further than ``sigmas`` deviations from their own sensor's mean."""
    spread = df.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("readings"),
        F.avg(column).alias("_mean"),
        F.stddev_samp(column).alias("_spread"),
    )
    attached = groupstats.attach(df, spread, broadcast_keys=broadcast_keys)
    distance = F.abs(F.col(column) - F.col("_mean"))
    strange = (F.col("_spread") > 0) & (distance > sigmas * F.col("_spread"))
    return attached.withColumn("anomaly", F.coalesce(strange, F.lit(False))).drop("_mean", "_spread")


def _anomalies() -> list[Column]:
    found, all_readings = F.count_if("anomaly"), F.count(F.lit(1))
    return [
        all_readings.alias("readings"),
        found.alias("anomalies"),
        _percent(found, all_readings).alias("anomaly_rate"),
    ]


def anomaly_rate(df: DataFrame, **options) -> DataFrame:
    """Number and share of anomalies over all readings."""
    return anomaly_flags(df, **options).agg(*_anomalies())


def anomaly_rate_per_sensor(df: DataFrame, **options) -> DataFrame:
    """Number and share of anomalies of each sensor."""
    return anomaly_flags(df, **options).groupBy("sensor_id").agg(*_anomalies())
