"""Sources and sinks: each query writes what Spark derives from the given table and reads it back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from weatherloom import schemas
from weatherloom.catalog.readings import as_source, events, readings, readings_raw, streamed
from weatherloom.catalog.registry import no_zone, registered, six
from weatherloom.catalog.rows import HALFWAY, READING, halfway, sigma_views
from weatherloom.operators import combine, filters, kpis, project, summary
from weatherloom.session import scratch_path
from weatherloom.sinks import audit, export, lake, timeline
from weatherloom.sources import database, files, report
from weatherloom.streaming import decode

CANONICAL_SQL = """id + 1 AS id, sensor_id, temperature, humidity, pressure, "timestamp", pm25, light,
    uv_level, rain_raw, wind_raw, vibration, 'Unknown' AS location"""
FIRST_RUN, SECOND_RUN = datetime(2024, 2, 1), datetime(2024, 2, 2)
AS_OF = "2024-02-14"


# --- database ------------------------------------------------------------------
# The increments run here on the given table; only the JDBC connection itself,
# which needs a database, is left to the user.


@registered(
    "src_jdbc_incremental",
    f"""SELECT {CANONICAL_SQL} FROM streamed
       WHERE id > (SELECT max(id) FROM readings WHERE "timestamp" < TIMESTAMP '{HALFWAY}')""",
)
def src_jdbc_incremental(spark, sf_dir):
    source = readings(spark, sf_dir).transform(as_source)
    mark = source.filter(F.col("timestamp") < halfway()).agg(F.max("id")).scalar()
    return no_zone(source.transform(database.new_readings, mark))


@registered(
    "src_jdbc_by_timestamp",
    f"""SELECT {READING} FROM readings WHERE "timestamp" > TIMESTAMP '{HALFWAY}' ORDER BY "timestamp", id LIMIT 100""",
)
def src_jdbc_by_timestamp(spark, sf_dir):
    return readings(spark, sf_dir).transform(database.new_readings_by_time, halfway())


@registered("src_count_max", "SELECT count(*) AS total, coalesce(max(id), 0) AS max_id FROM readings")
def src_count_max(spark, sf_dir):
    return readings(spark, sf_dir).transform(database.count_and_max_id)


@registered(
    "src_schema_report",
    """SELECT c.ordinal_position, c.column_name, c.data_type, c.is_nullable, s.sample
       FROM information_schema.columns c JOIN (
         SELECT name AS column_name, string_agg(cell, ' | ' ORDER BY event_id) AS sample FROM (
           SELECT event_id, unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']) AS name,
             unnest([CAST(event_id AS varchar), CAST(ts AS varchar), CAST(user_id AS varchar), event_type,
                     CAST(value AS varchar), props]) AS cell
           FROM (SELECT * FROM events ORDER BY event_id LIMIT 3)) GROUP BY name) s
       ON c.column_name = s.column_name WHERE c.table_name = 'events'""",
)
def src_schema_report(spark, sf_dir):
    return events(spark, sf_dir).transform(report.columns_with_sample, "event_id")


# --- files ---------------------------------------------------------------------


@registered(
    "src_parquet_dir",
    f"""SELECT id, sensor_id, temperature, "timestamp",
       CASE WHEN "timestamp" >= TIMESTAMP '{HALFWAY}' THEN light END AS light FROM readings""",
)
def src_parquet_dir(spark, sf_dir):
    root = scratch_path(spark, "tree")
    df = readings(spark, sf_dir).select("id", "sensor_id", "temperature", "timestamp", "light")
    df.filter(F.col("timestamp") < halfway()).drop("light").write.parquet(f"{root}/2024/01/a")
    df.filter(F.col("timestamp") >= halfway()).write.parquet(f"{root}/2024/01/b")
    return files.parquet_tree(spark, root, merge_schema=True)


@registered("src_file_filter", "SELECT id, sensor_id, temperature FROM readings")
def src_file_filter(spark, sf_dir):
    root = scratch_path(spark, "mixed")
    df = readings(spark, sf_dir).select("id", "sensor_id", "temperature")
    df.write.parquet(f"{root}/readings")
    df.groupBy("sensor_id").agg(F.count("id").alias("id")).write.parquet(f"{root}/run_log")
    df.limit(1).select("sensor_id").write.text(f"{root}/notes")
    tree = files.parquet_tree(spark, root, schema=df.schema, name_glob="*.parquet")
    return tree.transform(files.data_files_only, root)


@registered("src_skip_unreadable", "SELECT id, sensor_id, temperature FROM readings")
def src_skip_unreadable(spark, sf_dir):
    root = scratch_path(spark, "damaged")
    df = readings(spark, sf_dir).select("id", "sensor_id", "temperature")
    df.write.parquet(f"{root}/good")
    df.select(F.to_json(F.struct("id"))).write.text(f"{root}/damaged")
    return files.parquet_tree(spark, root, schema=df.schema, skip_unreadable=True)


@registered("src_empty_default", "SELECT id, sensor_id, temperature FROM readings")
def src_empty_default(spark, sf_dir):
    df = readings(spark, sf_dir).select("id", "sensor_id", "temperature")
    nothing = files.parquet_or_empty(spark, scratch_path(spark, "absent"), df.schema)
    return combine.by_name(df, nothing)


@registered(
    "src_kafka_json",
    """SELECT id, sensor_id, temperature, humidity, pressure, "timestamp", pm25, CAST(light AS bigint) AS light,
       CAST(uv_level AS bigint) AS uv_level, CAST(rain_raw AS bigint) AS rain_raw,
       CAST(wind_raw AS bigint) AS wind_raw, vibration, coalesce(location, 'Unknown') AS location,
       ingestion_timestamp, batch_id FROM streamed
       WHERE temperature IS NOT NULL AND humidity IS NOT NULL AND pressure IS NOT NULL""",
)
def src_kafka_json(spark, sf_dir):
    messages = project.as_messages(streamed(spark, sf_dir).drop("inserted_at"), keep_nulls=True)
    return no_zone(decode.accepted(decode.decoded(messages)))


# --- lake ----------------------------------------------------------------------


@registered(
    "sink_bronze_batch",
    f"""SELECT {CANONICAL_SQL},
       CASE WHEN id <= (SELECT max(id) FROM readings WHERE "timestamp" < TIMESTAMP '{HALFWAY}')
            THEN 'batch_20240201_000000' ELSE 'batch_20240202_000000' END AS batch_id FROM streamed""",
)
def sink_bronze_batch(spark, sf_dir):
    store = lake.Lake(scratch_path(spark, "bronze"))
    source = readings(spark, sf_dir).transform(as_source)
    lake.append_increment(source.filter(F.col("timestamp") < halfway()), store, at=F.lit(FIRST_RUN))
    lake.append_increment(source, store, at=F.lit(SECOND_RUN))
    return no_zone(lake.read_bronze(spark, store).drop("ingestion_timestamp"))


@registered(
    "sink_bronze_initial",
    f"""SELECT {CANONICAL_SQL}, concat('initial_batch_', lpad(CAST(id // 1000 AS varchar),
       CAST(greatest(4, length(CAST(id // 1000 AS varchar))) AS int), '0')) AS batch_id FROM streamed""",
)
def sink_bronze_initial(spark, sf_dir):
    store = lake.Lake(scratch_path(spark, "initial"))
    lake.initial_load(readings(spark, sf_dir).transform(as_source), store, at=F.lit(FIRST_RUN))
    return no_zone(lake.read_bronze(spark, store).drop("ingestion_timestamp"))


@registered("sink_parquet_overwrite", f"SELECT {READING} FROM readings")
def sink_parquet_overwrite(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    lake.write_snapshot(readings_raw(spark, sf_dir), path)
    lake.write_snapshot(readings(spark, sf_dir), path)
    return lake.read_snapshot(spark, path)


@registered("sink_csv", f"SELECT {READING} FROM readings")
def sink_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    df = readings(spark, sf_dir)
    export.to_csv(df, path)
    return spark.read.schema(df.schema).option("header", True).csv(path)


@registered("sink_json", f"SELECT {READING} FROM readings")
def sink_json(spark, sf_dir):
    path = scratch_path(spark, "json")
    df = readings(spark, sf_dir)
    export.to_json(df, path)
    return spark.read.schema(df.schema).json(path)


@registered(
    "sink_export_versioned",
    """SELECT 'total_readings' AS kpi_name, CAST(count(*) AS double) AS kpi_value FROM readings
       UNION ALL SELECT 'active_sensors', CAST(count(DISTINCT sensor_id) AS double) FROM readings
       UNION ALL SELECT 'avg_temperature_global', round(avg(temperature) + 1e-9, 6) FROM readings
       UNION ALL SELECT 'avg_humidity_global', round(avg(humidity) + 1e-9, 6) FROM readings
       UNION ALL SELECT 'avg_pressure_global', round(avg(pressure) + 1e-9, 6) FROM readings""",
)
def sink_export_versioned(spark, sf_dir):
    root = scratch_path(spark, "exports")
    df = readings(spark, sf_dir)
    older = df.filter(F.col("timestamp") < halfway())
    export.versioned(kpis.general(older), root, FIRST_RUN)
    export.versioned(kpis.general(df), root, SECOND_RUN)
    return six(export.latest_version(spark, root).select("kpi_name", "kpi_value"))


@registered(
    "sink_kafka",
    """SELECT sensor_id AS key, "timestamp", concat('Sensor ', right(sensor_id, 2)) AS sensor_name,
       round(temperature, 2) AS temperature, round(pm25, 2) AS pm25 FROM readings""",
)
def sink_kafka(spark, sf_dir):
    messages = readings(spark, sf_dir).transform(project.stream_record).transform(project.as_messages)
    body = F.from_json("value", "timestamp timestamp_ntz, sensor_name string, temperature double, pm25 double")
    return messages.select("key", body.alias("body")).select("key", "body.*")


@registered(
    "sink_olap_append",
    """SELECT id, sensor_id, temperature, inserted_at, CAST(strftime(inserted_at, '%Y%m') AS int) AS inserted_month
       FROM streamed""",
)
def sink_olap_append(spark, sf_dir):
    path = scratch_path(spark, "timeline")
    df = streamed(spark, sf_dir).select("id", "sensor_id", "temperature", "inserted_at")
    timeline.backfill(df.filter(F.col("inserted_at") < halfway()), path)
    timeline.append(df.filter(F.col("inserted_at") >= halfway()), path)
    return timeline.read(spark, path)


@registered(
    "sink_exec_log",
    """SELECT 'silver_cleaning' AS script, o AS records_processed, i - d AS duplicates_removed,
       d - o AS outliers_removed, 'silver/readings' AS output_file, 'completed' AS status
       FROM (SELECT (SELECT count(*) FROM readings_raw) AS i, (SELECT count(*) FROM distinct_raw) AS d,
                    (SELECT count(*) FROM kept) AS o)""",
    *sigma_views("distinct_raw", "stddev_samp"),
)
def sink_exec_log(spark, sf_dir):
    path = scratch_path(spark, "audit")
    metrics = readings_raw(spark, sf_dir).transform(summary.cleaning)
    audit.append(audit.cleaning_row(metrics, "silver_cleaning", "silver/readings", F.lit(FIRST_RUN)), path)
    return audit.read(spark, path).drop("execution_time")


@registered(
    "retention_filter",
    f"""SELECT id, sensor_id, temperature, CAST(ingestion_timestamp AS date) AS ingest_date FROM streamed
       WHERE CAST(ingestion_timestamp AS date) >= DATE '{AS_OF}' - INTERVAL '30' DAY""",
)
def retention_filter(spark, sf_dir):
    path = scratch_path(spark, "retention")
    dated = streamed(spark, sf_dir).select(
        "id", "sensor_id", "temperature", F.to_date("ingestion_timestamp").alias("ingest_date")
    )
    dated.write.partitionBy("ingest_date").parquet(path)
    for _ in range(2):  # the second run finds nothing to remove
        lake.drop_expired(spark, path, F.lit(AS_OF).cast("date"))
    return spark.read.schema(dated.schema).parquet(path)


@registered(
    "retention_view",
    f"""SELECT id, sensor_id, temperature, CAST(ingestion_timestamp AS date) AS ingest_date FROM streamed
       WHERE CAST(ingestion_timestamp AS date) >= DATE '{AS_OF}' - INTERVAL '30' DAY""",
)
def retention_view(spark, sf_dir):
    """The same rows where nothing is removed: a filter that prunes partitions."""
    path = scratch_path(spark, "retention")
    dated = streamed(spark, sf_dir).select(
        "id", "sensor_id", "temperature", F.to_date("ingestion_timestamp").alias("ingest_date")
    )
    dated.write.partitionBy("ingest_date").parquet(path)
    return spark.read.parquet(path).transform(filters.retained, F.lit(AS_OF).cast("date"))
