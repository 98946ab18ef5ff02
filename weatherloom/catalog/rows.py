"""Row operators: projections, filters, imputation, derived columns, duplicates, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom import schemas
from weatherloom.catalog.readings import as_source, readings, readings_raw, scored, streamed
from weatherloom.catalog.registry import (
    AIR_QUALITY_FIVE,
    AIR_QUALITY_FOUR,
    COMFORT_INDEX,
    QUALITY_SCORE,
    SENSOR_CATEGORY,
    no_zone,
    registered,
    six,
)
from weatherloom.functions import ladders, measures, times
from weatherloom.operators import combine, duplicates, filters, groupstats, impute, project
from weatherloom.session import scratch_path
from weatherloom.sinks import lake
from weatherloom.streaming import decode

HALFWAY = "2024-01-15 00:00:00"
READING = 'id, sensor_id, temperature, humidity, pressure, "timestamp", pm25, light, location, ingestion_timestamp'


def halfway():
    return F.lit(HALFWAY).cast("timestamp_ntz")


# --- projections ---------------------------------------------------------------


@registered(
    "proj_canonical",
    """SELECT id + 1 AS id, sensor_id, temperature, humidity, pressure, "timestamp", pm25, light,
       uv_level, rain_raw, wind_raw, vibration, 'Unknown' AS location FROM streamed""",
)
def proj_canonical(spark, sf_dir):
    return no_zone(readings(spark, sf_dir).transform(as_source).transform(project.canonical))


@registered("proj_alias_fallback", 'SELECT id, sensor_id AS ip, sensor_id, temperature FROM readings')
def proj_alias_fallback(spark, sf_dir):
    renamed = readings(spark, sf_dir).select("id", F.col("sensor_id").alias("ip"), "temperature")
    return renamed.transform(schemas.with_sensor_id)


@registered(
    "proj_ingest_meta",
    """SELECT id, sensor_id, "timestamp" + INTERVAL '1' HOUR AS ingestion_timestamp,
       concat('batch_', strftime("timestamp" + INTERVAL '1' HOUR, '%Y%m%d_%H%M%S')) AS batch_id FROM readings""",
)
def proj_ingest_meta(spark, sf_dir):
    df = readings(spark, sf_dir).select("id", "sensor_id", "timestamp")
    at = F.col("timestamp") + F.expr("INTERVAL 1 HOUR")
    return df.transform(project.ingest_stamps, at).drop("timestamp")


@registered("proj_reorder", f"SELECT {READING} FROM readings")
def proj_reorder(spark, sf_dir):
    return readings(spark, sf_dir).transform(project.leading, "timestamp", "ingestion_timestamp")


@registered(
    "proj_silver_sample",
    """SELECT sensor_id, temperature, humidity, pressure, round(temperature_fahrenheit + 1e-9, 6) AS temperature_fahrenheit,
       comfort_index, data_quality_score FROM scored ORDER BY id LIMIT 5""",
)
def proj_silver_sample(spark, sf_dir):
    sample = scored(spark, sf_dir).orderBy("id").limit(5)
    shown = sample.select(
        "sensor_id",
        "temperature",
        "humidity",
        "pressure",
        "temperature_fahrenheit",
        "comfort_index",
        "data_quality_score",
    )
    return six(shown, "temperature_fahrenheit")


@registered(
    "cast_ts_to_string",
    """SELECT id, CAST("timestamp" AS varchar) AS "timestamp",
       CAST(ingestion_timestamp AS varchar) AS ingestion_timestamp FROM readings""",
)
def cast_ts_to_string(spark, sf_dir):
    df = readings(spark, sf_dir).select("id", "timestamp", "ingestion_timestamp")
    return df.transform(project.timestamps_as_text)


@registered(
    "parse_ts_string",
    'SELECT id, CASE WHEN id % 3 <> 2 THEN "timestamp" END AS parsed FROM readings',
)
def parse_ts_string(spark, sf_dir):
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    form = F.col("id") % 3
    text = F.when(form == 0, F.concat(iso, F.lit("Z"))).when(form == 1, iso).otherwise("")
    df = readings(spark, sf_dir).select("id", text.alias("text"))
    return no_zone(df.select("id", times.parsed_timestamp(F.col("text")).alias("parsed")))


@registered(
    "format_stream_record",
    f"""SELECT "timestamp", sensor_id, concat('Sensor ', right(sensor_id, 2)) AS sensor_name,
       'Estación' AS location, round(temperature, 2) AS temperature, round(humidity, 2) AS humidity,
       round(pressure, 2) AS pressure, round(pm25, 2) AS pm25, CAST(light AS double) AS light,
       {AIR_QUALITY_FIVE.format('pm25')} AS air_quality FROM readings""",
)
def format_stream_record(spark, sf_dir):
    return readings(spark, sf_dir).transform(project.stream_record)


@registered(
    "default_missing_fields",
    """SELECT id, sensor_id, coalesce(temperature, 0) AS temperature, coalesce(humidity, 0) AS humidity,
       coalesce(pressure, 0) AS pressure, "timestamp", pm25, CAST(light AS bigint) AS light,
       CAST(uv_level AS bigint) AS uv_level, CAST(0 AS bigint) AS rain_raw, CAST(wind_raw AS bigint) AS wind_raw,
       vibration, coalesce(location, 'Unknown') AS location, ingestion_timestamp, '' AS batch_id, false AS rejected
       FROM streamed""",
)
def default_missing_fields(spark, sf_dir):
    incomplete = streamed(spark, sf_dir).drop("inserted_at", "rain_raw", "batch_id")
    decoded = decode.decoded(project.as_messages(incomplete))
    return no_zone(decoded.drop("message"))


# --- filters -------------------------------------------------------------------


@registered(
    "filter_key_not_null",
    'SELECT id, sensor_id, "timestamp" FROM readings WHERE sensor_id IS NOT NULL AND "timestamp" IS NOT NULL',
)
def filter_key_not_null(spark, sf_dir):
    kept = readings(spark, sf_dir).transform(filters.present, "sensor_id", "timestamp")
    return kept.select("id", "sensor_id", "timestamp")


@registered(
    "filter_ip_temp_not_null",
    "SELECT id, sensor_id AS ip, temperature FROM readings WHERE sensor_id IS NOT NULL AND temperature IS NOT NULL",
)
def filter_ip_temp_not_null(spark, sf_dir):
    df = readings(spark, sf_dir).select("id", F.col("sensor_id").alias("ip"), "temperature")
    return df.transform(filters.present, "ip", "temperature")


VALID_SQL = """temperature BETWEEN -50 AND 70 AND humidity BETWEEN 0 AND 100 AND pressure BETWEEN 800 AND 1200"""


@registered("filter_valid_range", f"SELECT {READING} FROM readings WHERE {VALID_SQL}")
def filter_valid_range(spark, sf_dir):
    return readings(spark, sf_dir).transform(filters.valid_range)


@registered(
    "filter_valid_range_keep_nulls",
    f"""SELECT {READING} FROM readings WHERE (temperature IS NULL OR temperature BETWEEN -50 AND 70)
       AND (humidity IS NULL OR humidity BETWEEN 0 AND 100) AND (pressure IS NULL OR pressure BETWEEN 800 AND 1200)""",
)
def filter_valid_range_keep_nulls(spark, sf_dir):
    return readings(spark, sf_dir).transform(filters.valid_range, nulls="keep")


def sigma_views(source: str, deviation: str) -> tuple[str, str]:
    return (
        f"""stats AS (SELECT avg(temperature) AS m, {deviation}(temperature) AS s FROM {source})""",
        f"""kept AS (SELECT r.* FROM {source} r, stats
            WHERE coalesce(s, 0) <= 0 OR temperature BETWEEN m - 5 * s AND m + 5 * s)""",
    )


def distinct_readings(spark, sf_dir):
    """The distinct readings, written once for the passes that follow."""
    return lake.staged(duplicates.exact(readings_raw(spark, sf_dir)), scratch_path(spark, "distinct"))


@registered("filter_sigma5_sample", f"SELECT {READING} FROM kept", *sigma_views("distinct_raw", "stddev_samp"))
def filter_sigma5_sample(spark, sf_dir):
    return distinct_readings(spark, sf_dir).transform(filters.sigma)


@registered("filter_sigma5_population", f"SELECT {READING} FROM kept", *sigma_views("distinct_raw", "stddev_pop"))
def filter_sigma5_population(spark, sf_dir):
    return distinct_readings(spark, sf_dir).transform(filters.sigma, population=True)


@registered(
    "filter_id_gt",
    f"""SELECT id, sensor_id, temperature FROM readings
       WHERE id > (SELECT max(id) FROM readings WHERE "timestamp" < TIMESTAMP '{HALFWAY}')""",
)
def filter_id_gt(spark, sf_dir):
    df = readings(spark, sf_dir)
    mark = df.filter(F.col("timestamp") < halfway()).agg(F.max("id")).scalar()
    return df.transform(filters.id_after, mark).select("id", "sensor_id", "temperature")


@registered(
    "filter_ts_gt",
    f"""SELECT id, sensor_id, "timestamp", temperature FROM readings WHERE "timestamp" > TIMESTAMP '{HALFWAY}'""",
)
def filter_ts_gt(spark, sf_dir):
    df = readings(spark, sf_dir).transform(filters.time_after, halfway())
    return df.select("id", "sensor_id", "timestamp", "temperature")


@registered(
    "filter_last_interval",
    f"""SELECT {READING} FROM readings
       WHERE "timestamp" > (SELECT max("timestamp") FROM readings) - INTERVAL '10' MINUTE
       ORDER BY "timestamp" DESC, id DESC""",
)
def filter_last_interval(spark, sf_dir):
    df = readings(spark, sf_dir)
    return df.transform(filters.last_interval, times.newest(df))


@registered("filter_pm25_alert", f'SELECT {READING} FROM readings WHERE pm25 > 100 ORDER BY "timestamp" DESC, id DESC')
def filter_pm25_alert(spark, sf_dir):
    return readings(spark, sf_dir).transform(filters.pm25_alert_newest_first)


# --- imputation ----------------------------------------------------------------

FILLED = ("temperature", "humidity", "pressure")
GLOBAL_MEDIANS = """medians AS (SELECT quantile_disc(temperature, 0.5) AS t, quantile_disc(humidity, 0.5) AS h,
    quantile_disc(pressure, 0.5) AS p FROM readings)"""


@registered(
    "impute_median_global",
    """SELECT id, sensor_id, round(coalesce(temperature, t) + 1e-9, 6) AS temperature,
       round(coalesce(humidity, h) + 1e-9, 6) AS humidity, round(coalesce(pressure, p) + 1e-9, 6) AS pressure
       FROM readings, medians""",
    GLOBAL_MEDIANS,
)
def impute_median_global(spark, sf_dir):
    df = readings(spark, sf_dir).select("id", "sensor_id", *FILLED)
    return six(df.transform(impute.median_global))


@registered(
    "impute_median_per_sensor",
    """SELECT id, r.sensor_id, round(coalesce(temperature, st, t) + 1e-9, 6) AS temperature,
       round(coalesce(humidity, sh, h) + 1e-9, 6) AS humidity, round(coalesce(pressure, sp, p) + 1e-9, 6) AS pressure
       FROM readings r LEFT JOIN per_sensor s ON r.sensor_id = s.sensor_id, medians""",
    GLOBAL_MEDIANS,
    """per_sensor AS (SELECT sensor_id, quantile_disc(temperature, 0.5) AS st, quantile_disc(humidity, 0.5) AS sh,
       quantile_disc(pressure, 0.5) AS sp FROM readings GROUP BY sensor_id)""",
)
def impute_median_per_sensor(spark, sf_dir):
    df = readings(spark, sf_dir).select("id", "sensor_id", *FILLED)
    return six(df.transform(impute.median_per_sensor))


MEANS = """means AS (SELECT avg(temperature) AS t, avg(humidity) AS h, avg(pressure) AS p, avg(pm25) AS q,
    avg(light) AS l FROM {0})"""
MEAN_FILLED = """round(coalesce(temperature, t) + 1e-9, 6) AS temperature, round(coalesce(humidity, h) + 1e-9, 6) AS humidity,
    round(coalesce(pressure, p) + 1e-9, 6) AS pressure, round(coalesce(pm25, q) + 1e-9, 6) AS pm25,
    round(coalesce(light, l) + 1e-9, 6) AS light"""


@registered(
    "impute_mean_global",
    f"SELECT id, sensor_id, {MEAN_FILLED} FROM kept, means",
    *sigma_views("distinct_raw", "stddev_samp"),
    MEANS.format("kept"),
)
def impute_mean_global(spark, sf_dir):
    kept = distinct_readings(spark, sf_dir).transform(filters.sigma)
    filled = kept.transform(impute.mean_global)
    return six(filled.select("id", "sensor_id", *V.MEAN_IMPUTED_COLUMNS))


@registered(
    "impute_mean_global_all",
    f"SELECT id, sensor_id, {MEAN_FILLED} FROM readings, means",
    MEANS.format("readings"),
)
def impute_mean_global_all(spark, sf_dir):
    df = readings(spark, sf_dir).select("id", "sensor_id", *V.MEAN_IMPUTED_COLUMNS)
    return six(df.transform(impute.mean_global))


@registered("impute_location_unknown", "SELECT id, coalesce(location, 'Unknown') AS location FROM readings")
def impute_location_unknown(spark, sf_dir):
    return readings(spark, sf_dir).select("id", "location").transform(impute.unknown_location)


# --- derived columns -----------------------------------------------------------


@registered(
    "derive_fahrenheit",
    "SELECT id, round(temperature * 1.8 + 32 + 1e-9, 6) AS temperature_fahrenheit FROM readings",
)
def derive_fahrenheit(spark, sf_dir):
    value = measures.fahrenheit(F.col("temperature")).alias("temperature_fahrenheit")
    return six(readings(spark, sf_dir).select("id", value))


@registered("derive_comfort_index", f"SELECT id, {COMFORT_INDEX} AS comfort_index FROM readings")
def derive_comfort_index(spark, sf_dir):
    index = measures.comfort_index(F.col("temperature"), F.col("humidity"))
    return readings(spark, sf_dir).select("id", index.alias("comfort_index"))


@registered("derive_quality_score", f"SELECT id, {QUALITY_SCORE} AS data_quality_score FROM readings")
def derive_quality_score(spark, sf_dir):
    return readings(spark, sf_dir).transform(project.quality_score).select("id", "data_quality_score")


@registered("derive_sensor_category", f"SELECT id, sensor_id, {SENSOR_CATEGORY} AS sensor_category FROM readings")
def derive_sensor_category(spark, sf_dir):
    category = measures.sensor_category(F.col("sensor_id")).alias("sensor_category")
    return readings(spark, sf_dir).select("id", "sensor_id", category)


@registered("derive_processing_ts", "SELECT id, true AS stamped_after_reading FROM readings")
def derive_processing_ts(spark, sf_dir):
    stamped = readings(spark, sf_dir).transform(project.processing_stamp)
    return stamped.select("id", (F.col("processing_timestamp") > F.col("timestamp")).alias("stamped_after_reading"))


@registered(
    "derive_time_parts",
    """SELECT id, CAST(year("timestamp") AS int) AS year, CAST(month("timestamp") AS int) AS month,
       CAST(day("timestamp") AS int) AS day, CAST(hour("timestamp") AS int) AS hour FROM readings""",
)
def derive_time_parts(spark, sf_dir):
    return readings(spark, sf_dir).select("id", "timestamp").transform(project.time_parts).drop("timestamp")


@registered("derive_air_quality_row", f"SELECT id, {AIR_QUALITY_FIVE.format('pm25')} AS air_quality FROM readings")
def derive_air_quality_row(spark, sf_dir):
    return readings(spark, sf_dir).select("id", ladders.air_quality_five(F.col("pm25")).alias("air_quality"))


@registered(
    "classify_air_quality_avg_5",
    f"""SELECT sensor_id, round(avg(pm25) + 1e-9, 6) AS pm25_avg, {AIR_QUALITY_FIVE.format('avg(pm25)')}
       AS air_quality_category FROM readings GROUP BY sensor_id""",
)
def classify_air_quality_avg_5(spark, sf_dir):
    means = readings(spark, sf_dir).groupBy("sensor_id").agg(F.avg("pm25").alias("pm25_avg"))
    return six(means.withColumn("air_quality_category", ladders.air_quality_five(F.col("pm25_avg"))))


@registered(
    "classify_air_quality_avg_4",
    f"""SELECT sensor_id, round(avg(pm25) + 1e-9, 6) AS pm25_avg, {AIR_QUALITY_FOUR.format('avg(pm25)')}
       AS air_quality_category FROM readings GROUP BY sensor_id""",
)
def classify_air_quality_avg_4(spark, sf_dir):
    means = readings(spark, sf_dir).groupBy("sensor_id").agg(F.avg("pm25").alias("pm25_avg"))
    return six(means.withColumn("air_quality_category", ladders.air_quality_four(F.col("pm25_avg"))))


@registered(
    "classify_system_status",
    """SELECT sensor_id, round(p + 1e-9, 6) AS high_quality_percent,
       CASE WHEN p >= 95 THEN 'EXCELENTE' WHEN p >= 80 THEN 'BUENO' ELSE 'REQUIERE ATENCIÓN' END AS system_status
       FROM (SELECT sensor_id, 100.0 * count(*) FILTER (WHERE data_quality_score >= 90) / count(*) AS p
             FROM scored GROUP BY sensor_id)""",
)
def classify_system_status(spark, sf_dir):
    high = F.count_if(F.col("data_quality_score") >= V.HIGH_QUALITY)
    shares = (
        scored(spark, sf_dir)
        .groupBy("sensor_id")
        .agg((100.0 * high / F.count(F.lit(1))).alias("high_quality_percent"))
    )
    return six(shares.withColumn("system_status", ladders.system_status(F.col("high_quality_percent"))))


BAND = "CASE WHEN {0} IS NULL THEN NULL {1} ELSE '{2}' END"


def _band(column: str, metric: str) -> str:
    lowest, steps = V.DASHBOARD_BANDS[metric]
    rungs = " ".join(f"WHEN {column} >= {bound} THEN '{label}'" for bound, label in reversed(steps))
    return BAND.format(column, rungs, lowest)


@registered(
    "band_thresholds",
    "SELECT id, "
    + ", ".join(f"{_band(m.removesuffix('_gauge'), m)} AS {m}_band" for m in V.DASHBOARD_BANDS)
    + " FROM readings",
)
def band_thresholds(spark, sf_dir):
    bands = [
        ladders.dashboard_band(F.col(m.removesuffix("_gauge")), m).alias(f"{m}_band") for m in V.DASHBOARD_BANDS
    ]
    return readings(spark, sf_dir).select("id", *bands)


# --- duplicates ----------------------------------------------------------------


@registered("dedup_exact", f"SELECT {READING} FROM distinct_raw")
def dedup_exact(spark, sf_dir):
    return readings_raw(spark, sf_dir).transform(duplicates.exact)


@registered("dedup_key_any", 'SELECT DISTINCT sensor_id, "timestamp" FROM readings_raw')
def dedup_key_any(spark, sf_dir):
    return readings_raw(spark, sf_dir).transform(duplicates.any_per_key).select(*V.READING_KEY)


@registered("dedup_key_last", f"SELECT {READING} FROM newest_per_key")
def dedup_key_last(spark, sf_dir):
    return readings_raw(spark, sf_dir).transform(duplicates.last_per_key)


# --- statistics attached to rows -----------------------------------------------


@registered(
    "join_global_stat",
    """SELECT id, round(temperature - m + 1e-9, 6) AS from_mean, round((temperature - m) / s + 1e-9, 6) AS deviations
       FROM readings, (SELECT avg(temperature) AS m, stddev_samp(temperature) AS s FROM readings)""",
)
def join_global_stat(spark, sf_dir):
    df = readings(spark, sf_dir).select("id", "temperature")
    known = groupstats.with_global(
        df, "all", F.avg("temperature").alias("mean"), F.stddev_samp("temperature").alias("spread")
    )
    from_mean = F.col("temperature") - F.col("all.mean")
    return six(
        known.select("id", from_mean.alias("from_mean"), (from_mean / F.col("all.spread")).alias("deviations"))
    )


@registered(
    "join_sensor_stat",
    """SELECT id, r.sensor_id, round(temperature - m + 1e-9, 6) AS from_sensor_mean FROM readings r
       JOIN (SELECT sensor_id, avg(temperature) AS m FROM readings GROUP BY sensor_id) s
       ON r.sensor_id = s.sensor_id""",
)
def join_sensor_stat(spark, sf_dir):
    df = readings(spark, sf_dir).select("id", "sensor_id", "temperature")
    stats = df.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("readings"), F.avg("temperature").alias("mean"))
    attached = groupstats.attach(df, stats)
    return six(
        attached.select("id", "sensor_id", (F.col("temperature") - F.col("mean")).alias("from_sensor_mean"))
    )


# --- unions --------------------------------------------------------------------


@registered(
    "union_by_name",
    f"""SELECT id, sensor_id, temperature,
       CASE WHEN "timestamp" >= TIMESTAMP '{HALFWAY}' THEN humidity END AS humidity FROM readings""",
)
def union_by_name(spark, sf_dir):
    df = readings(spark, sf_dir)
    older = df.filter(F.col("timestamp") < halfway()).select("temperature", "id", "sensor_id")
    newer = df.filter(F.col("timestamp") >= halfway()).select("id", "sensor_id", "temperature", "humidity")
    return combine.by_name(older, newer)


@registered("union_positional", "SELECT id, sensor_id, temperature FROM readings")
def union_positional(spark, sf_dir):
    df = readings(spark, sf_dir)
    older = df.filter(F.col("timestamp") < halfway()).select("id", "sensor_id", "temperature")
    newer = df.filter(F.col("timestamp") >= halfway()).select("id", "sensor_id", "temperature")
    return combine.by_position(older, newer)
