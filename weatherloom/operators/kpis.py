"""KPI tables: long rows by family, the whole long table, and the wide row.

The long table costs one pass over the readings. Readings are reduced to one
row of mergeable parts (counts, sums, extremes) per sensor and location; the
grouping sets for the global, per-sensor and per-location rows then run over
those few rows only. The wide row can be had from the same parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom.functions import ladders, times

# grouping_id of (sensor_id, location): a set bit means "rolled up"
ALL_READINGS, ONE_SENSOR, ONE_LOCATION = 3, 1, 2


def _text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


def _slug(column: str) -> str:
    return f"replace(lower({column}), ' ', '_')"


def _filled(pattern: str, value: str | None) -> str:
    """SQL text for a pattern whose ``{}`` is filled from a column."""
    if value is None:
        return _text(pattern)
    return "concat(" + ", ".join([_text(pattern.split("{}")[0]), value, _text(pattern.split("{}")[1])]) + ")"


def _kpi(spec, value: str, keep: str | None = None, sensor: str | None = None, location: str | None = None) -> str:
    """SQL text of one long row; NULL where ``keep`` does not hold."""
    name, category, unit, text = spec
    key = sensor or location
    row = f"""named_struct(
        'kpi_name', {_filled(name, _slug(key) if location else key)},
        'kpi_category', {_text(category)},
        'kpi_value', CAST({value} AS double),
        'kpi_unit', {_text(unit)},
        'description', {_filled(text, key)},
        'sensor_id', {sensor or "CAST(NULL AS string)"},
        'location', {location or "CAST(NULL AS string)"})"""
    return row if keep is None else f"if({keep}, {row}, NULL)"


def _array(rows: list[str]) -> str:
    return "array(" + ", ".join(rows) + ")"


def _long(df: DataFrame, rows: list[str], drop: tuple[str, ...] = ()) -> DataFrame:
    return df.selectExpr(f"inline(array_compact({_array(rows)}))").drop(*drop)


def general(df: DataFrame) -> DataFrame:
    """Readings, active sensors, and the means of the measures there are."""
    one = df.agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_distinct("sensor_id").alias("sensors"),
        *[F.avg(c).alias(f"avg_{c}") for c in V.MEDIAN_IMPUTED_COLUMNS if c in df.columns],
    )
    rows = [_kpi(s, k) for k, s in V.GENERAL_KPIS.items() if k in one.columns]
    return _long(one, rows, ("sensor_id", "location"))


def per_sensor(df: DataFrame) -> DataFrame:
    """Mean, highest and lowest temperature and the number of readings of each sensor."""
    sensors = (
        df.filter(F.col("sensor_id").isNotNull())
        .groupBy("sensor_id")
        .agg(
            F.avg("temperature").alias("avg_temperature"),
            F.max("temperature").alias("max_temperature"),
            F.min("temperature").alias("min_temperature"),
            F.count(F.lit(1)).alias("readings"),
        )
    )
    return _long(sensors, _sensor_rows(), ("location",))


def _sensor_rows() -> list[str]:
    return [_kpi(s, k, sensor="sensor_id") for k, s in V.SENSOR_KPIS.items()]


def per_location(df: DataFrame) -> DataFrame:
    """Distinct sensors and mean temperature of each known location."""
    places = (
        df.filter(F.col("location").isNotNull())
        .groupBy("location")
        .agg(
            F.count_distinct("sensor_id").alias("sensors"),
            F.avg("temperature").alias("avg_temperature"),
        )
    )
    return _long(places, _location_rows(), ("sensor_id",))


def _location_rows() -> list[str]:
    return [_kpi(s, k, location="location") for k, s in V.LOCATION_KPIS.items()]


def _since(as_of: Column, column: str = "timestamp") -> dict[str, Column]:
    at = F.col(column)
    return {
        "last_24h": F.count_if(at >= times.before(as_of, "24 HOURS")),
        "last_week": F.count_if(at >= times.before(as_of, "7 DAYS")),
    }


def temporal(df: DataFrame, as_of=None) -> DataFrame:
    """Readings of the last day and week; a row only where there are any."""
    one = df.agg(*[c.alias(k) for k, c in _since(times.moment(as_of)).items()])
    rows = [_kpi(s, k, keep=f"{k} > 0") for k, s in V.TEMPORAL_KPIS.items()]
    return _long(one, rows, ("sensor_id", "location"))


def _high_quality(score: str = "data_quality_score") -> Column:
    return F.count_if(F.col(score) >= V.HIGH_QUALITY)


def quality(df: DataFrame) -> DataFrame:
    """Mean quality score and the number of high-quality readings."""
    one = df.agg(
        F.avg("data_quality_score").alias("avg_quality"),
        _high_quality().alias("high_quality"),
    )
    return _long(one, [_kpi(s, k) for k, s in V.QUALITY_KPIS.items()], ("sensor_id", "location"))


def completeness(df: DataFrame) -> DataFrame:
    """Share of readings that carry each value, in percent; nothing for no readings."""
    one = df.agg(
        F.count(F.lit(1)).alias("readings"),
        *[F.count(c).alias(c) for c in V.COMPLETENESS_KPIS],
    )
    return _long(one, _completeness_rows("{}"), ("sensor_id", "location"))


def _completeness_rows(count: str) -> list[str]:
    return [
        _kpi(s, f"try_divide(100D * {count.format(c)}, readings)", keep="readings > 0")
        for c, s in V.COMPLETENESS_KPIS.items()
    ]


def alert_counts(
    low_temperature: float = V.LOW_TEMPERATURE, columns=("temperature", "humidity")
) -> dict[str, Column]:
    """Aggregates counting the readings beyond each limit, for the columns there are."""
    t, h = F.col("temperature"), F.col("humidity")
    counts = {
        "high_temperature": t > V.HIGH_TEMPERATURE,
        "low_temperature": t < low_temperature,
        "high_humidity": h > V.HIGH_HUMIDITY,
        "low_humidity": h < V.LOW_HUMIDITY,
    }
    return {k: F.count_if(beyond) for k, beyond in counts.items() if k.split("_")[1] in columns}


def alerts(df: DataFrame) -> DataFrame:
    """Readings beyond each limit, as long rows."""
    counts = alert_counts(columns=df.columns)
    one = df.agg(*[c.alias(k) for k, c in counts.items()])
    return _long(one, [_kpi(V.ALERT_KPIS[k], k) for k in counts], ("sensor_id", "location"))


def alert_summary(df: DataFrame, low_temperature: float = V.LOW_TEMPERATURE) -> DataFrame:
    """The alert counts as one JSON text, and their total."""
    one = df.agg(*[c.alias(k) for k, c in alert_counts(low_temperature).items()])
    return one.select(
        F.to_json(F.struct(*V.ALERT_KPIS)).alias("alerts_json"),
        sum((F.col(k) for k in V.ALERT_KPIS), F.lit(0)).alias("total_alerts"),
    )


def pressure_alerts(df: DataFrame, low: float = V.LOW_PRESSURE, high: float = V.HIGH_PRESSURE) -> DataFrame:
    """Readings with an unusually low or high pressure."""
    p = F.col("pressure")
    return df.agg(
        F.count_if(p < low).alias("low_pressure_alerts"),
        F.count_if(p > high).alias("high_pressure_alerts"),
    )


def _quality_parts() -> list[Column]:
    return [
        F.sum("data_quality_score").alias("sum_quality"),
        F.count("data_quality_score").alias("n_quality"),
        _high_quality().alias("high_quality"),
    ]


MEASURED = ("temperature", "humidity", "pressure")


def parts(df: DataFrame, as_of=None) -> DataFrame:
    """Mergeable parts of every KPI, one row per sensor and location. Parts that a reader does not use cost it nothing."""
    held = [*MEASURED, *(["pm25"] if "pm25" in df.columns else [])]
    return df.groupBy("sensor_id", "location").agg(
        F.count(F.lit(1)).alias("readings"),
        *[f(c).alias(f"{name}_{c}") for name, f in (("sum", F.sum), ("n", F.count), ("max", F.max), ("min", F.min)) for c in held],
        F.var_pop("temperature").alias("variance_temperature"),
        *([] if "data_quality_score" not in df.columns else _quality_parts()),
        *[c.alias(k) for k, c in _since(times.moment(as_of)).items()],
        *[c.alias(k) for k, c in alert_counts().items()],
    )


def long_table(df: DataFrame, as_of=None, generated_at=None) -> DataFrame:
    """All families of long rows with the time they were generated.

    Rows on the quality score are there if the readings carry one.
    """
    return long_of_parts(parts(df, as_of), generated_at)


def long_of_parts(held: DataFrame, generated_at=None) -> DataFrame:
    """The long table from :func:`parts`."""
    measured = MEASURED
    scored = "sum_quality" in held.columns
    summed = (
        ["readings"]
        + (["sum_quality", "n_quality", "high_quality"] if scored else [])
        + [f"{p}_{c}" for p in ("sum", "n") for c in measured]
        + list(V.TEMPORAL_KPIS)
        + list(V.ALERT_KPIS)
    )
    groups = (
        held.groupingSets([[], ["sensor_id"], ["location"]], "sensor_id", "location")
        .agg(
            F.grouping_id().alias("level"),
            *[F.sum(c).alias(c) for c in summed],
            F.max("max_temperature").alias("max_temperature"),
            F.min("min_temperature").alias("min_temperature"),
            F.count_distinct("sensor_id").alias("sensors"),
        )
    )

    averaged = (*measured, "quality") if scored else measured
    means = groups.selectExpr("*", *[f"try_divide(sum_{c}, n_{c}) AS avg_{c}" for c in averaged])
    overall = (
        [_kpi(s, k) for k, s in V.GENERAL_KPIS.items()]
        + [_kpi(s, k, keep=f"{k} > 0") for k, s in V.TEMPORAL_KPIS.items()]
        + [_kpi(s, k) for k, s in V.QUALITY_KPIS.items() if scored]
        + _completeness_rows("n_{}")
        + [_kpi(s, k) for k, s in V.ALERT_KPIS.items()]
    )
    rows = f"""CASE
        WHEN level = {ALL_READINGS} THEN {_array(overall)}
        WHEN level = {ONE_SENSOR} AND sensor_id IS NOT NULL THEN {_array(_sensor_rows())}
        WHEN level = {ONE_LOCATION} AND location IS NOT NULL THEN {_array(_location_rows())}
        END"""
    long_rows = means.selectExpr(f"inline(array_compact({rows}))")
    return long_rows.withColumn("generated_at", times.moment(generated_at))


def wide(
    df: DataFrame,
    low_temperature: float = V.LOW_TEMPERATURE,
    air_quality=ladders.air_quality_four,
    count_missing_sensor: bool = False,
) -> DataFrame:
    """One row with one column per KPI, from a single pass.

    An empty input gives zeros, and a measure the input lacks gives no column.
    ``count_missing_sensor`` counts readings without a sensor as one more sensor.
    """
    known = "sensor_id" in df.columns
    sensors = F.count_distinct("sensor_id") if known else F.lit(0)
    if known and count_missing_sensor:
        sensors = sensors + F.coalesce(F.max(F.col("sensor_id").isNull().cast("int")), F.lit(0))
    statistics = {
        "temperature": {"avg": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp},
        "humidity": {"avg": F.avg, "max": F.max, "min": F.min},
        "pm25": {"avg": F.avg, "max": F.max},
        "pressure": {"avg": F.avg, "max": F.max, "min": F.min},
    }
    counts = alert_counts(low_temperature, df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("total_readings"),
        sensors.alias("unique_sensors"),
        *[
            F.coalesce(f(c).cast("double"), F.lit(0.0)).alias(f"{c}_{s}")
            for c, by_name in statistics.items()
            for s, f in by_name.items()
            if c in df.columns
        ],
        *[c.alias(k) for k, c in counts.items()],
    )
    return _wide_columns(row, air_quality, list(counts))


def _wide_columns(row: DataFrame, air_quality, counts: list[str]) -> DataFrame:
    if "pm25_avg" in row.columns:
        row = row.withColumn("air_quality_category", air_quality(F.col("pm25_avg")))
    if counts:
        row = row.withColumn("alerts_json", F.to_json(F.struct(*counts)))
    return row.select(*[c for c in V.WIDE_KPI_COLUMNS if c in row.columns])


def wide_of_parts(held: DataFrame) -> DataFrame:
    """The wide row from :func:`parts`; squared deviations are merged around the mean of all readings."""
    counts = list(alert_counts())
    mean = held.agg(F.try_divide(F.sum("sum_temperature"), F.sum("n_temperature"))).scalar()
    n, own = F.col("n_temperature"), F.try_divide("sum_temperature", "n_temperature")
    squares = F.sum(n * (F.col("variance_temperature") + (own - mean) * (own - mean)))
    measures = [c for c in ("temperature", "humidity", "pm25", "pressure") if f"n_{c}" in held.columns]
    values = {"temperature_std": F.sqrt(F.try_divide(squares, F.sum(n) - 1))}
    for c in measures:
        values |= {f"{c}_avg": F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}")), f"{c}_max": F.max(f"max_{c}"), f"{c}_min": F.min(f"min_{c}")}
    row = held.agg(
        F.coalesce(F.sum("readings"), F.lit(0)).alias("total_readings"),
        F.count_distinct("sensor_id").alias("unique_sensors"),
        *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(k) for k, v in values.items() if k in V.WIDE_KPI_COLUMNS],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
    )
    return _wide_columns(row, ladders.air_quality_four, counts)


def wide_notebook(df: DataFrame) -> DataFrame:
    """The wide row in its second variant: five air bands, a lower cold limit."""
    return wide(df, V.LOW_TEMPERATURE_NOTEBOOK, ladders.air_quality_five, count_missing_sensor=True)


def stamped(df: DataFrame, at=None) -> DataFrame:
    """A wide row with its generation time in front, as text and as a timestamp."""
    at = times.moment(at)
    return df.select(at.cast("string").alias("timestamp"), at.alias("generation_time"), *df.columns)
