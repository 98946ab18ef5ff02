"""Streaming queries: each drains the given table as a file stream and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherloom.catalog.readings import (
    EVENTS,
    as_all_columns,
    as_readings,
    as_readings_raw,
    event_stream,
    events,
)
from weatherloom.catalog.registry import AIR_QUALITY_FIVE, no_zone, registered, six
from weatherloom.operators import project
from weatherloom.session import scratch_path
from weatherloom.sinks import timeline
from weatherloom.streaming import ingest, publish, reports, run, sources


def zoned(df):
    """Event time must carry a zone before it can have a watermark."""
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def reading_stream(spark, sf_dir):
    return zoned(as_readings(event_stream(spark, sf_dir)))


def message_stream(spark, sf_dir, keep_nulls=False):
    rows = as_all_columns(as_readings(event_stream(spark, sf_dir))).drop("inserted_at")
    return project.as_messages(rows, keep_nulls=keep_nulls).select("value")


def drained(df, path, checkpoint):
    run.to_files(df, path, checkpoint).awaitTermination()
    return df.sparkSession.read.parquet(path)


def ingested(spark, sf_dir, root, keep_nulls):
    messages = message_stream(spark, sf_dir, keep_nulls)
    query = ingest.start(messages, f"{root}/table", f"{root}/checkpoint", "sensors")
    query.awaitTermination()
    return query


MESSAGE_NUMBERS = """CAST(light AS bigint) AS light, CAST(uv_level AS bigint) AS uv_level,
    CAST(rain_raw AS bigint) AS rain_raw, CAST(wind_raw AS bigint) AS wind_raw"""


@registered(
    "stream_ingest",
    f"""SELECT id, sensor_id, coalesce(temperature, 0) AS temperature, coalesce(humidity, 0) AS humidity,
       coalesce(pressure, 0) AS pressure, "timestamp", pm25, {MESSAGE_NUMBERS}, vibration,
       coalesce(location, 'Unknown') AS location, ingestion_timestamp, batch_id, true AS stamped FROM streamed""",
)
def stream_ingest(spark, sf_dir):
    root = scratch_path(spark, "ingest")
    ingested(spark, sf_dir, root, keep_nulls=False)
    table = timeline.read(spark, f"{root}/table").drop(timeline.MONTH)
    stamped = table.withColumn("stamped", F.col("inserted_at").isNotNull()).drop("inserted_at")
    return no_zone(stamped)


@registered(
    "stream_bad_records",
    """SELECT id, temperature IS NULL OR humidity IS NULL OR pressure IS NULL AS rejected FROM readings""",
)
def stream_bad_records(spark, sf_dir):
    root = scratch_path(spark, "bad")
    ingested(spark, sf_dir, root, keep_nulls=True)
    good = timeline.read(spark, f"{root}/table").select("id", F.lit(False).alias("rejected"))
    bad = ingest.quarantined(spark, f"{root}/table")
    bad_ids = F.get_json_object("message", "$.id").cast("bigint")
    return good.unionByName(bad.select(bad_ids.alias("id"), F.lit(True).alias("rejected")))


@registered(
    "stream_counters",
    """SELECT count(*) AS received,
       count(*) FILTER (temperature IS NOT NULL AND humidity IS NOT NULL AND pressure IS NOT NULL) AS inserted,
       count(*) FILTER (temperature IS NULL OR humidity IS NULL OR pressure IS NULL) AS errors FROM readings""",
)
def stream_counters(spark, sf_dir):
    root = scratch_path(spark, "counters")
    ingested(spark, sf_dir, root, keep_nulls=True)
    return ingest.counters(spark, f"{root}/table")


@registered("stream_drain_once", "SELECT id, sensor_id FROM readings")
def stream_drain_once(spark, sf_dir):
    root = scratch_path(spark, "drain")
    stream = reading_stream(spark, sf_dir).select("id", "sensor_id")
    return drained(stream, f"{root}/out", f"{root}/checkpoint")


@registered("stream_rate_limit", "SELECT count(*) AS readings, 4 AS micro_batches FROM readings")
def stream_rate_limit(spark, sf_dir):
    root = scratch_path(spark, "rate")
    events(spark, sf_dir).repartition(4, "event_id").write.parquet(f"{root}/in")
    stream = sources.reading_files(spark, f"{root}/in", EVENTS, files_per_batch=1)

    def store(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{root}/out/epoch={epoch}")

    run.per_batch(stream, store, f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").agg(
        F.count(F.lit(1)).alias("readings"), F.count_distinct("epoch").cast("int").alias("micro_batches")
    )


@registered("stream_progress", "SELECT id, sensor_id, temperature FROM readings")
def stream_progress(spark, sf_dir):
    """Started three times on one checkpoint; the later starts find nothing new."""
    root = scratch_path(spark, "progress")
    for _ in range(3):
        stream = reading_stream(spark, sf_dir).select("id", "sensor_id", "temperature")
        table = drained(stream, f"{root}/out", f"{root}/checkpoint")
    return table


@registered(
    "stream_source_mark",
    """SELECT 'events' AS source, "timestamp" AS mark_timestamp, id AS mark_id FROM readings
       ORDER BY "timestamp" DESC, id DESC LIMIT 1""",
)
def stream_source_mark(spark, sf_dir):
    root = scratch_path(spark, "mark")
    stream = reading_stream(spark, sf_dir).select("id", "timestamp")

    def commit(batch, epoch):
        publish.commit_time_mark(batch, f"{root}/marks", "events", "main", epoch)

    run.per_batch(stream, commit, f"{root}/checkpoint").awaitTermination()
    return no_zone(publish.last_time_mark(spark, f"{root}/marks", "events"))


@registered(
    "stream_db_to_topic",
    f"""SELECT "timestamp", sensor_id, concat('Sensor ', right(sensor_id, 2)) AS sensor_name,
       'Estación' AS location, round(temperature, 2) AS temperature, round(humidity, 2) AS humidity,
       round(pressure, 2) AS pressure, round(pm25, 2) AS pm25, CAST(light AS double) AS light,
       {AIR_QUALITY_FIVE.format('pm25')} AS air_quality FROM readings""",
)
def stream_db_to_topic(spark, sf_dir):
    root = scratch_path(spark, "publish")
    stream = as_readings(event_stream(spark, sf_dir))
    publish.to_files(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    schema = stream.transform(project.stream_record).schema
    lines = spark.read.text(f"{root}/out")
    return lines.select(F.from_json("value", schema).alias("record")).select("record.*")


@registered(
    "stream_dashboard",
    """SELECT count(*) AS total,
       round(avg(temperature), 1) AS temperature_avg, round(min(temperature), 1) AS temperature_min,
       round(max(temperature), 1) AS temperature_max, round(avg(humidity), 1) AS humidity_avg,
       round(min(humidity), 1) AS humidity_min, round(max(humidity), 1) AS humidity_max,
       round(avg(pressure), 1) AS pressure_avg, round(min(pressure), 1) AS pressure_min,
       round(max(pressure), 1) AS pressure_max, round(avg(pm25), 1) AS pm25_avg, round(min(pm25), 1) AS pm25_min,
       round(max(pm25), 1) AS pm25_max FROM readings""",
)
def stream_dashboard(spark, sf_dir):
    return _dashboard(spark, sf_dir, "totals")


@registered(
    "stream_dashboard_sensors",
    """SELECT sensor_id, count(*) AS total, round(avg(temperature) + 1e-9, 6) AS temp_promedio,
       round(avg(humidity) + 1e-9, 6) AS humidity_promedio FROM readings GROUP BY sensor_id""",
)
def stream_dashboard_sensors(spark, sf_dir):
    return six(_dashboard(spark, sf_dir, "sensors"))


def _dashboard(spark, sf_dir, panel):
    root = scratch_path(spark, "dashboard")
    reports.dashboard(reading_stream(spark, sf_dir), f"{root}/out", f"{root}/checkpoint", run.DRAIN).awaitTermination()
    return reports.panel(spark, f"{root}/out", panel)


@registered("stream_alerts", 'SELECT id, sensor_id, "timestamp", pm25 FROM readings WHERE pm25 > 100')
def stream_alerts(spark, sf_dir):
    root = scratch_path(spark, "alerts")
    stream = reports.alerts(reading_stream(spark, sf_dir)).select("id", "sensor_id", "timestamp", "pm25")
    return no_zone(drained(stream, f"{root}/out", f"{root}/checkpoint"))


@registered(
    "stream_window_report",
    """SELECT window_start, window_start + INTERVAL '10 minutes' AS window_end, sensor_id,
         CAST(count(*) AS bigint) AS readings, round(avg(temperature) + 1e-9, 6) AS avg_temperature,
         round(min(temperature) + 1e-9, 6) AS min_temperature, round(max(temperature) + 1e-9, 6) AS max_temperature
       FROM (SELECT *, time_bucket(INTERVAL '10 minutes', "timestamp") AS window_start FROM readings)
       GROUP BY window_start, sensor_id""",
)
def stream_window_report(spark, sf_dir):
    root = scratch_path(spark, "windows")
    reports.window_parts(reading_stream(spark, sf_dir), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return six(no_zone(reports.windows(spark, f"{root}/out")))


@registered("stream_dedup", 'SELECT DISTINCT sensor_id, "timestamp" FROM readings_raw')
def stream_dedup(spark, sf_dir):
    root = scratch_path(spark, "dedup")
    repeated = zoned(as_readings_raw(as_readings(event_stream(spark, sf_dir))))
    stream = repeated.select("sensor_id", "timestamp")
    reports.store_distinct(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return no_zone(reports.distinct_readings(spark, f"{root}/out").select("sensor_id", "timestamp"))
