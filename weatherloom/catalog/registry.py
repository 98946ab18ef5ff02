"""How a query and its SQL twin are registered, and the SQL views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

QUALITY_SCORE = """CASE WHEN temperature IS NOT NULL AND humidity IS NOT NULL AND pressure IS NOT NULL THEN 100
    WHEN temperature IS NOT NULL AND humidity IS NOT NULL THEN 75
    WHEN temperature IS NOT NULL THEN 50 ELSE 25 END"""
COMFORT_INDEX = """CASE WHEN temperature BETWEEN 20 AND 25 AND humidity BETWEEN 40 AND 60 THEN 'Comfortable'
    WHEN temperature < 18 OR temperature > 28 THEN 'Uncomfortable'
    WHEN humidity < 30 OR humidity > 70 THEN 'Uncomfortable' ELSE 'Moderate' END"""
SENSOR_CATEGORY = """CASE WHEN sensor_id LIKE 'TEMP%' THEN 'Temperature' WHEN sensor_id LIKE 'HUM%' THEN 'Humidity'
    WHEN sensor_id LIKE 'PRES%' THEN 'Pressure' ELSE 'Multi-sensor' END"""
AIR_QUALITY_FIVE = """CASE WHEN {0} > 150 THEN 'Peligroso' WHEN {0} > 100 THEN 'Muy insalubre'
    WHEN {0} > 50 THEN 'Insalubre' WHEN {0} > 25 THEN 'Moderado' ELSE 'Bueno' END"""
AIR_QUALITY_FOUR = """CASE WHEN {0} <= 12 THEN 'Buena' WHEN {0} <= 35.4 THEN 'Moderada'
    WHEN {0} <= 55.4 THEN 'Insalubre para grupos sensibles' ELSE 'Insalubre' END"""

# The given events as readings. ``readings_raw`` is the whole of ``readings`` with
# exact copies and late corrections of some of them added.
VIEWS = f"""readings AS (
  SELECT event_id AS id,
    concat(CASE user_id % 4 WHEN 0 THEN 'TEMP_' WHEN 1 THEN 'HUM_' WHEN 2 THEN 'PRES_' ELSE '10.0.0.' END,
           lpad(CAST(user_id AS varchar), 6, '0')) AS sensor_id,
    CASE WHEN event_id % 37 = 0 THEN NULL ELSE value - 20 END AS temperature,
    CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS double) END AS humidity,
    CASE WHEN event_id % 43 = 0 THEN NULL ELSE 780 + CAST(event_id * 7919 % 50000 AS double) / 100 END AS pressure,
    ts AS "timestamp", value AS pm25, CAST(event_id * 31 % 2500 AS int) AS light,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE event_type END AS location,
    ts + INTERVAL '1' HOUR AS ingestion_timestamp
  FROM events),
readings_raw AS (
  SELECT * FROM readings
  UNION ALL SELECT * FROM readings WHERE id % 100 = 0
  UNION ALL SELECT id + 1000000000, sensor_id, temperature + 1, humidity, pressure, "timestamp", pm25, light,
    location, ingestion_timestamp + INTERVAL '1' HOUR FROM readings WHERE id % 97 = 0),
streamed AS (
  SELECT *, CAST(id * 17 % 16 AS int) AS uv_level, CAST(id * 13 % 801 AS int) AS rain_raw,
    CAST(id * 11 % 401 AS int) AS wind_raw, id % 5 = 0 AS vibration,
    concat('batch_', strftime(date_trunc('day', ingestion_timestamp), '%Y%m%d_%H%M%S')) AS batch_id,
    ingestion_timestamp AS inserted_at
  FROM readings),
scored AS (
  SELECT *, {QUALITY_SCORE} AS data_quality_score, temperature * 1.8 + 32 AS temperature_fahrenheit,
    {COMFORT_INDEX} AS comfort_index, {SENSOR_CATEGORY} AS sensor_category
  FROM readings),
distinct_raw AS (SELECT DISTINCT * FROM readings_raw),
newest_per_key AS (
  SELECT * EXCLUDE (rank) FROM (
    SELECT *, row_number() OVER (PARTITION BY sensor_id, "timestamp"
                                 ORDER BY ingestion_timestamp DESC, id DESC) AS rank FROM readings_raw)
  WHERE rank = 1)"""


def with_views(select: str, *more: str) -> str:
    """A SELECT preceded by the shared views and any further ones."""
    return "WITH " + ",\n".join((VIEWS, *more)) + "\n" + select


def registered(name: str, sql: str | None = None, *views: str) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL twin if it has one."""

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = with_views(sql, *views)
        return query

    return register


def six(df: DataFrame, *columns: str) -> DataFrame:
    """Round the named columns, or all double ones, to six places.

    The last digits of a sum of doubles depend on the order of addition. A mean
    of two-place values over, say, 32 rows lies exactly between two six-place
    numbers, where that digit would decide; the small shift, also in the SQL
    twins, moves such means off the edge.
    """
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in names})


def no_zone(df: DataFrame) -> DataFrame:
    """Timestamps as the given tables hold them, without a zone."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

