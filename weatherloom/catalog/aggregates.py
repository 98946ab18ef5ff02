"""KPI tables, per-sensor and per-location reports, summaries, dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom.catalog.readings import readings, readings_raw, scored, streamed
from weatherloom.catalog.registry import AIR_QUALITY_FIVE, AIR_QUALITY_FOUR, registered, six
from weatherloom.catalog.rows import sigma_views
from weatherloom.functions import times
from weatherloom.operators import dashboards, filters, impute, kpis, sensors, summary
from weatherloom.sinks import lake
from weatherloom.session import scratch_path

# --- long KPI rows -------------------------------------------------------------

GENERAL_SQL = """
SELECT 'total_readings' AS kpi_name, 'general' AS kpi_category, CAST(count(*) AS double) AS kpi_value,
  'count' AS kpi_unit, 'Número total de lecturas de sensores' AS description FROM {0}
UNION ALL SELECT 'active_sensors', 'general', CAST(count(DISTINCT sensor_id) AS double), 'count',
  'Número de sensores únicos activos' FROM {0}
UNION ALL SELECT 'avg_temperature_global', 'general', round(avg(temperature) + 1e-9, 6), 'celsius',
  'Temperatura promedio global' FROM {0}
UNION ALL SELECT 'avg_humidity_global', 'general', round(avg(humidity) + 1e-9, 6), 'percent',
  'Humedad promedio global' FROM {0}
UNION ALL SELECT 'avg_pressure_global', 'general', round(avg(pressure) + 1e-9, 6), 'hpa',
  'Presión promedio global' FROM {0}"""

SENSOR_SQL = """
SELECT concat('avg_temperature_', sensor_id) AS kpi_name, 'sensor' AS kpi_category,
  round(avg(temperature) + 1e-9, 6) AS kpi_value, 'celsius' AS kpi_unit,
  concat('Temperatura promedio del sensor ', sensor_id) AS description, sensor_id
  FROM {0} WHERE sensor_id IS NOT NULL GROUP BY sensor_id
UNION ALL SELECT concat('max_temperature_', sensor_id), 'sensor', round(max(temperature) + 1e-9, 6), 'celsius',
  concat('Temperatura máxima del sensor ', sensor_id), sensor_id
  FROM {0} WHERE sensor_id IS NOT NULL GROUP BY sensor_id
UNION ALL SELECT concat('min_temperature_', sensor_id), 'sensor', round(min(temperature) + 1e-9, 6), 'celsius',
  concat('Temperatura mínima del sensor ', sensor_id), sensor_id
  FROM {0} WHERE sensor_id IS NOT NULL GROUP BY sensor_id
UNION ALL SELECT concat('readings_count_', sensor_id), 'sensor', CAST(count(*) AS double), 'count',
  concat('Número de lecturas del sensor ', sensor_id), sensor_id
  FROM {0} WHERE sensor_id IS NOT NULL GROUP BY sensor_id"""

LOCATION_SQL = """
SELECT concat('sensors_in_', replace(lower(location), ' ', '_')) AS kpi_name, 'location' AS kpi_category,
  CAST(count(DISTINCT sensor_id) AS double) AS kpi_value, 'count' AS kpi_unit,
  concat('Número de sensores en ', location) AS description, location
  FROM {0} WHERE location IS NOT NULL GROUP BY location
UNION ALL SELECT concat('avg_temperature_', replace(lower(location), ' ', '_')), 'location',
  round(avg(temperature) + 1e-9, 6), 'celsius', concat('Temperatura promedio en ', location), location
  FROM {0} WHERE location IS NOT NULL GROUP BY location"""

TEMPORAL_SQL = """
SELECT * FROM (
  SELECT 'readings_last_24h' AS kpi_name, 'temporal' AS kpi_category,
    CAST(count(*) FILTER (WHERE "timestamp" >= (SELECT max("timestamp") FROM {0}) - INTERVAL '24' HOUR) AS double) AS kpi_value,
    'count' AS kpi_unit, 'Lecturas en las últimas 24 horas' AS description FROM {0}
  UNION ALL SELECT 'readings_last_week', 'temporal',
    CAST(count(*) FILTER (WHERE "timestamp" >= (SELECT max("timestamp") FROM {0}) - INTERVAL '7' DAY) AS double),
    'count', 'Lecturas en la última semana' FROM {0})
WHERE kpi_value > 0"""

QUALITY_SQL = """
SELECT 'avg_data_quality' AS kpi_name, 'quality' AS kpi_category, round(avg(data_quality_score) + 1e-9, 6) AS kpi_value,
  'score' AS kpi_unit, 'Puntuación promedio de calidad de datos' AS description FROM {0}
UNION ALL SELECT 'high_quality_readings', 'quality', CAST(count(*) FILTER (WHERE data_quality_score >= 90) AS double), 'count',
  'Lecturas con alta calidad (>=90)' FROM {0}"""

COMPLETENESS_SQL = """
SELECT 'completeness_temperature' AS kpi_name, 'quality' AS kpi_category,
  round(100.0 * count(temperature) / count(*) + 1e-9, 6) AS kpi_value, 'percent' AS kpi_unit,
  'Porcentaje de completitud para temperature' AS description FROM {0} HAVING count(*) > 0
UNION ALL SELECT 'completeness_humidity', 'quality', round(100.0 * count(humidity) / count(*) + 1e-9, 6), 'percent',
  'Porcentaje de completitud para humidity' FROM {0} HAVING count(*) > 0
UNION ALL SELECT 'completeness_pressure', 'quality', round(100.0 * count(pressure) / count(*) + 1e-9, 6), 'percent',
  'Porcentaje de completitud para pressure' FROM {0} HAVING count(*) > 0"""

ALERTS_SQL = """
SELECT 'high_temperature_alerts' AS kpi_name, 'alerts' AS kpi_category,
  CAST(count(*) FILTER (WHERE temperature > 30) AS double) AS kpi_value, 'count' AS kpi_unit,
  'Alertas de temperatura alta (>30°C)' AS description FROM {0}
UNION ALL SELECT 'low_temperature_alerts', 'alerts', CAST(count(*) FILTER (WHERE temperature < 10) AS double), 'count',
  'Alertas de temperatura baja (<10°C)' FROM {0}
UNION ALL SELECT 'high_humidity_alerts', 'alerts', CAST(count(*) FILTER (WHERE humidity > 80) AS double), 'count',
  'Alertas de humedad alta (>80%)' FROM {0}
UNION ALL SELECT 'low_humidity_alerts', 'alerts', CAST(count(*) FILTER (WHERE humidity < 20) AS double), 'count',
  'Alertas de humedad baja (<20%)' FROM {0}"""


def long_table_sql(source: str, scored_source: bool = True) -> str:
    plain = [GENERAL_SQL, TEMPORAL_SQL, COMPLETENESS_SQL, ALERTS_SQL] + ([QUALITY_SQL] if scored_source else [])
    parts = [f"SELECT *, CAST(NULL AS varchar) AS sensor_id, CAST(NULL AS varchar) AS location FROM ({q})" for q in plain]
    parts.append(
        "SELECT kpi_name, kpi_category, kpi_value, kpi_unit, description, sensor_id, "
        f"CAST(NULL AS varchar) AS location FROM ({SENSOR_SQL})"
    )
    parts.append(
        "SELECT kpi_name, kpi_category, kpi_value, kpi_unit, description, CAST(NULL AS varchar) AS sensor_id, "
        f"location FROM ({LOCATION_SQL})"
    )
    return "\nUNION ALL\n".join(parts).format(source)


@registered("kpi_general", GENERAL_SQL.format("readings"))
def kpi_general(spark, sf_dir):
    return six(readings(spark, sf_dir).transform(kpis.general))


@registered("kpi_per_sensor", SENSOR_SQL.format("readings"))
def kpi_per_sensor(spark, sf_dir):
    return six(readings(spark, sf_dir).transform(kpis.per_sensor))


@registered("kpi_per_location", LOCATION_SQL.format("readings"))
def kpi_per_location(spark, sf_dir):
    return six(readings(spark, sf_dir).transform(kpis.per_location))


@registered("kpi_temporal", TEMPORAL_SQL.format("readings"))
def kpi_temporal(spark, sf_dir):
    df = readings(spark, sf_dir)
    return df.transform(kpis.temporal, times.newest(df))


@registered("kpi_quality", QUALITY_SQL.format("scored"))
def kpi_quality(spark, sf_dir):
    return six(scored(spark, sf_dir).transform(kpis.quality))


@registered("kpi_completeness", COMPLETENESS_SQL.format("readings"))
def kpi_completeness(spark, sf_dir):
    return six(readings(spark, sf_dir).transform(kpis.completeness))


@registered("kpi_alerts", ALERTS_SQL.format("readings"))
def kpi_alerts(spark, sf_dir):
    return readings(spark, sf_dir).transform(kpis.alerts)


@registered(
    "kpi_long_table",
    """SELECT *, (SELECT max("timestamp") FROM scored) AS generated_at FROM (""" + long_table_sql("scored") + ")",
)
def kpi_long_table(spark, sf_dir):
    df = scored(spark, sf_dir)
    as_of = times.newest(df)
    return six(df.transform(kpis.long_table, as_of, as_of))


# --- wide KPI row --------------------------------------------------------------


def wide_sql(source: str, low_temperature: int = 10, air_quality: str = AIR_QUALITY_FOUR, sensors_sql: str = "") -> str:
    sensors_sql = sensors_sql or "count(DISTINCT sensor_id)"
    return f"""SELECT count(*) AS total_readings, {sensors_sql} AS unique_sensors,
  round(coalesce(avg(temperature), 0) + 1e-9, 6) AS temperature_avg, round(coalesce(max(temperature), 0) + 1e-9, 6) AS temperature_max,
  round(coalesce(min(temperature), 0) + 1e-9, 6) AS temperature_min,
  round(coalesce(stddev_samp(temperature), 0) + 1e-9, 6) AS temperature_std,
  round(coalesce(avg(humidity), 0) + 1e-9, 6) AS humidity_avg, round(coalesce(max(humidity), 0) + 1e-9, 6) AS humidity_max,
  round(coalesce(min(humidity), 0) + 1e-9, 6) AS humidity_min,
  round(coalesce(avg(pm25), 0) + 1e-9, 6) AS pm25_avg, round(coalesce(max(pm25), 0) + 1e-9, 6) AS pm25_max,
  {air_quality.format('coalesce(avg(pm25), 0)')} AS air_quality_category,
  round(coalesce(avg(pressure), 0) + 1e-9, 6) AS pressure_avg, round(coalesce(max(pressure), 0) + 1e-9, 6) AS pressure_max,
  round(coalesce(min(pressure), 0) + 1e-9, 6) AS pressure_min, {alerts_json_sql(low_temperature)} AS alerts_json
FROM {source}"""


def alerts_json_sql(low_temperature: int = 10) -> str:
    return f"""concat('{{"high_temperature":', count(*) FILTER (WHERE temperature > 30), ',"low_temperature":',
  count(*) FILTER (WHERE temperature < {low_temperature}), ',"high_humidity":', count(*) FILTER (WHERE humidity > 80), ',"low_humidity":',
  count(*) FILTER (WHERE humidity < 20), '}}')"""


@registered("kpi_wide", wide_sql("readings"))
def kpi_wide(spark, sf_dir):
    return six(readings(spark, sf_dir).transform(kpis.wide))


@registered(
    "kpi_wide_notebook",
    wide_sql(
        "readings",
        5,
        AIR_QUALITY_FIVE,
        "count(DISTINCT sensor_id) + coalesce(max(CASE WHEN sensor_id IS NULL THEN 1 ELSE 0 END), 0)",
    ),
)
def kpi_wide_notebook(spark, sf_dir):
    return six(readings(spark, sf_dir).transform(kpis.wide_notebook))


@registered(
    "alerts_struct",
    f"""SELECT {alerts_json_sql()} AS alerts_json, count(*) FILTER (WHERE temperature > 30) + count(*) FILTER (WHERE temperature < 10)
       + count(*) FILTER (WHERE humidity > 80) + count(*) FILTER (WHERE humidity < 20) AS total_alerts FROM readings""",
)
def alerts_struct(spark, sf_dir):
    return readings(spark, sf_dir).transform(kpis.alert_summary)


@registered(
    "pressure_alerts",
    """SELECT count(*) FILTER (WHERE pressure < 950) AS low_pressure_alerts, count(*) FILTER (WHERE pressure > 1050) AS high_pressure_alerts
       FROM readings""",
)
def pressure_alerts(spark, sf_dir):
    return readings(spark, sf_dir).transform(kpis.pressure_alerts)


# --- per sensor, per location --------------------------------------------------


def sensor_statistics_sql(source: str) -> str:
    return f"""SELECT sensor_id, count(*) AS readings_count, round(avg(temperature) + 1e-9, 6) AS temp_avg,
  round(max(temperature) + 1e-9, 6) AS temp_max, round(min(temperature) + 1e-9, 6) AS temp_min,
  round(avg(humidity) + 1e-9, 6) AS humidity_avg FROM {source} GROUP BY sensor_id"""


@registered("sensor_statistics", sensor_statistics_sql("readings"))
def sensor_statistics(spark, sf_dir):
    return six(readings(spark, sf_dir).transform(sensors.statistics))


@registered("sensor_statistics_ranked", sensor_statistics_sql("readings") + " ORDER BY readings_count DESC, sensor_id")
def sensor_statistics_ranked(spark, sf_dir):
    return six(readings(spark, sf_dir).transform(sensors.statistics_ranked))


@registered(
    "stream_table_per_sensor",
    """SELECT sensor_id, count(*) AS total, round(avg(temperature) + 1e-9, 6) AS temp_promedio,
       round(avg(humidity) + 1e-9, 6) AS humidity_promedio FROM streamed GROUP BY sensor_id""",
)
def stream_table_per_sensor(spark, sf_dir):
    return six(streamed(spark, sf_dir).transform(sensors.averages))


ANOMALY_VIEWS = (
    """spread AS (SELECT sensor_id, avg(temperature) AS m, stddev_samp(temperature) AS s
       FROM readings GROUP BY sensor_id)""",
    """flagged AS (SELECT r.sensor_id, coalesce(s > 0 AND abs(temperature - m) > 3 * s, false) AS anomaly
       FROM readings r LEFT JOIN spread ON r.sensor_id = spread.sensor_id)""",
)
ANOMALY_COLUMNS = """count(*) AS readings, count(*) FILTER (WHERE anomaly) AS anomalies,
    round(100.0 * count(*) FILTER (WHERE anomaly) / count(*) + 1e-9, 6) AS anomaly_rate"""


@registered("anomaly_rate", f"SELECT {ANOMALY_COLUMNS} FROM flagged", *ANOMALY_VIEWS)
def anomaly_rate(spark, sf_dir):
    return six(readings(spark, sf_dir).transform(sensors.anomaly_rate))


@registered(
    "anomaly_rate_per_sensor",
    f"SELECT sensor_id, {ANOMALY_COLUMNS} FROM flagged GROUP BY sensor_id",
    *ANOMALY_VIEWS,
)
def anomaly_rate_per_sensor(spark, sf_dir):
    return six(readings(spark, sf_dir).transform(sensors.anomaly_rate_per_sensor))


@registered(
    "sensor_quality",
    """SELECT sensor_id, count(*) AS readings, round(avg(data_quality_score) + 1e-9, 6) AS avg_quality,
       round(100.0 * count(temperature) / count(*) + 1e-9, 6) AS completeness_temperature,
       round(100.0 * count(humidity) / count(*) + 1e-9, 6) AS completeness_humidity,
       round(100.0 * count(pressure) / count(*) + 1e-9, 6) AS completeness_pressure FROM scored GROUP BY sensor_id""",
)
def sensor_quality(spark, sf_dir):
    return six(scored(spark, sf_dir).transform(sensors.quality))


@registered(
    "location_comfort",
    """SELECT location, count(DISTINCT sensor_id) AS sensors, round(avg(temperature) + 1e-9, 6) AS avg_temperature,
       round(avg(humidity) + 1e-9, 6) AS avg_humidity, round(avg(pressure) + 1e-9, 6) AS avg_pressure,
       count(*) FILTER (WHERE comfort_index = 'Comfortable') AS comfortable,
       count(*) FILTER (WHERE comfort_index = 'Uncomfortable') AS uncomfortable,
       count(*) FILTER (WHERE comfort_index = 'Moderate') AS moderate FROM scored GROUP BY location""",
)
def location_comfort(spark, sf_dir):
    return six(scored(spark, sf_dir).transform(sensors.location_comfort))


# --- single statistics ---------------------------------------------------------


@registered(
    "median_approx",
    """SELECT round(quantile_disc(temperature, 0.5) + 1e-9, 6) AS median_temperature,
       round(quantile_disc(humidity, 0.5) + 1e-9, 6) AS median_humidity,
       round(quantile_disc(pressure, 0.5) + 1e-9, 6) AS median_pressure FROM readings""",
)
def median_approx(spark, sf_dir):
    measured = ("temperature", "humidity", "pressure")
    found = impute.medians(readings(spark, sf_dir), measured)
    return six(found.select(*[F.col(c).alias(f"median_{c}") for c in measured]))


@registered(
    "temp_mean_std",
    "SELECT round(avg(temperature) + 1e-9, 6) AS mean, round(stddev_samp(temperature) + 1e-9, 6) AS std FROM distinct_raw",
)
def temp_mean_std(spark, sf_dir):
    distinct = readings_raw(spark, sf_dir).dropDuplicates()
    return six(distinct.agg(F.avg("temperature").alias("mean"), F.stddev_samp("temperature").alias("std")))


# --- summaries -----------------------------------------------------------------


@registered(
    "silver_summary",
    """SELECT count(*) AS total_records, count(DISTINCT sensor_id) AS unique_sensors,
       strftime(min("timestamp"), '%Y-%m-%d %H:%M:%S') AS range_start,
       strftime(max("timestamp"), '%Y-%m-%d %H:%M:%S') AS range_end,
       round(avg(data_quality_score) + 1e-9, 6) AS avg_quality_score,
       count(*) FILTER (WHERE data_quality_score = 100) AS complete_records, round(avg(temperature) + 1e-9, 6) AS avg_temperature,
       round(avg(humidity) + 1e-9, 6) AS avg_humidity, round(avg(pressure) + 1e-9, 6) AS avg_pressure FROM scored""",
)
def silver_summary(spark, sf_dir):
    one = scored(spark, sf_dir).transform(summary.silver)
    return six(
        one.select(
            "total_records",
            "unique_sensors",
            F.col("date_range.start").alias("range_start"),
            F.col("date_range.end").alias("range_end"),
            "data_quality.*",
            "sensor_stats.*",
        )
    )


@registered(
    "group_quality_score",
    "SELECT data_quality_score, count(*) AS count FROM scored GROUP BY data_quality_score ORDER BY data_quality_score",
)
def group_quality_score(spark, sf_dir):
    return scored(spark, sf_dir).transform(summary.by_quality_score)


@registered(
    "group_comfort_index",
    """SELECT comfort_index, count(*) AS readings, count(DISTINCT sensor_id) AS sensors,
       round(avg(temperature) + 1e-9, 6) AS avg_temperature, round(avg(humidity) + 1e-9, 6) AS avg_humidity FROM scored
       WHERE temperature BETWEEN -50 AND 70 AND humidity BETWEEN 0 AND 100 AND pressure BETWEEN 800 AND 1200
       GROUP BY comfort_index""",
)
def group_comfort_index(spark, sf_dir):
    valid = scored(spark, sf_dir).transform(filters.valid_range)
    return six(valid.transform(summary.by_comfort_index))


@registered(
    "avg_quality",
    """SELECT round(a + 1e-9, 6) AS avg_quality, n AS high_quality_readings, round(p + 1e-9, 6) AS high_quality_percent,
       CASE WHEN p >= 95 THEN 'EXCELENTE' WHEN p >= 80 THEN 'BUENO' ELSE 'REQUIERE ATENCIÓN' END AS system_status
       FROM (SELECT avg(data_quality_score) AS a, count(*) FILTER (WHERE data_quality_score >= 90) AS n,
             100.0 * count(*) FILTER (WHERE data_quality_score >= 90) / count(*) AS p FROM scored)""",
)
def avg_quality(spark, sf_dir):
    return six(scored(spark, sf_dir).transform(summary.quality))


CLEANING_SQL = """SELECT i AS rows_in, i - d AS duplicates_removed, d - o AS outliers_removed, o AS rows_out,
    round(100.0 * o / i + 1e-9, 6) AS percent_kept
    FROM (SELECT (SELECT count(*) FROM readings_raw) AS i, (SELECT count(*) FROM distinct_raw) AS d,
                 (SELECT count(*) FROM kept) AS o)"""


@registered("clean_metrics", CLEANING_SQL, *sigma_views("distinct_raw", "stddev_samp"))
def clean_metrics(spark, sf_dir):
    return six(readings_raw(spark, sf_dir).transform(summary.cleaning))


@registered(
    "layer_profile",
    """SELECT 'bronze' AS layer, true AS has_files, count(*) AS readings FROM readings_raw
       UNION ALL SELECT 'silver', true, count(*) FROM distinct_raw
       UNION ALL SELECT 'gold', true, count(DISTINCT sensor_id) FROM distinct_raw""",
)
def layer_profile(spark, sf_dir):
    root = scratch_path(spark, "layers")
    raw = readings_raw(spark, sf_dir)
    silver = raw.dropDuplicates()
    layers = {"bronze": raw, "silver": silver, "gold": sensors.statistics(silver)}
    paths = {name: f"{root}/{name}" for name in layers}
    for name, df in layers.items():
        lake.staged(df, paths[name])
    profile = summary.layers(spark, paths)
    return profile.select("layer", (F.col("files") > 0).alias("has_files"), "readings")


# --- dashboard aggregates ------------------------------------------------------


@registered("dash_total", "SELECT count(*) AS total FROM streamed")
def dash_total(spark, sf_dir):
    return streamed(spark, sf_dir).transform(dashboards.total)


@registered(
    "dash_gauge_avg",
    """SELECT round(avg(temperature), 1) AS temperature, round(avg(humidity), 1) AS humidity,
       round(avg(pressure), 1) AS pressure, round(avg(pm25), 1) AS pm25 FROM streamed""",
)
def dash_gauge_avg(spark, sf_dir):
    return streamed(spark, sf_dir).transform(dashboards.gauges)


EXTREMES_SQL = """SELECT 'Temperatura' AS "Metrica", round(min(temperature), 1) AS "Minimo",
    round(avg(temperature), 1) AS "Promedio", round(max(temperature), 1) AS "Maximo" FROM streamed
  UNION ALL SELECT 'Humedad', round(min(humidity), 1), round(avg(humidity), 1), round(max(humidity), 1) FROM streamed
  UNION ALL SELECT 'Presion', round(min(pressure), 1), round(avg(pressure), 1), round(max(pressure), 1) FROM streamed"""


@registered("dash_stats_table", EXTREMES_SQL)
def dash_stats_table(spark, sf_dir):
    return streamed(spark, sf_dir).transform(dashboards.extremes)


@registered("union_all_sql", EXTREMES_SQL)
def union_all_sql(spark, sf_dir):
    """The three rows in SQL: one aggregate, unpivoted."""
    table = streamed(spark, sf_dir).select(*V.DASHBOARD_METRIC_NAMES)
    sums = ", ".join(f"round({f}({c}), 1) AS {c}_{f}" for c in V.DASHBOARD_METRIC_NAMES for f in ("min", "avg", "max"))
    sides = ", ".join(f"({c}_min, {c}_avg, {c}_max) AS {label}" for c, label in V.DASHBOARD_METRIC_NAMES.items())
    text = f"""SELECT {V.DASHBOARD_METRIC}, {", ".join(V.DASHBOARD_EXTREMES)} FROM (SELECT {sums} FROM {{table}})
        UNPIVOT INCLUDE NULLS (({", ".join(V.DASHBOARD_EXTREMES)}) FOR {V.DASHBOARD_METRIC} IN ({sides}))"""
    return spark.sql(text, table=table)
