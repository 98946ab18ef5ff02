"""Newest rows, batches, snapshots; pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherloom.catalog.readings import as_source, readings, streamed
from weatherloom.catalog.registry import registered, six
from weatherloom.catalog.rows import HALFWAY, READING, halfway
from weatherloom.operators import dashboards, latest

STREAMED = READING + ", uv_level, rain_raw, wind_raw, vibration, batch_id, inserted_at"


@registered(
    "dash_latest_value",
    """SELECT round(temperature, 1) AS temperature, round(humidity, 1) AS humidity, round(pressure, 1) AS pressure,
       round(pm25, 1) AS pm25, light FROM streamed ORDER BY inserted_at DESC, id DESC LIMIT 1""",
)
def dash_latest_value(spark, sf_dir):
    return streamed(spark, sf_dir).transform(dashboards.latest_values)


@registered(
    "dash_series_100",
    """SELECT id, inserted_at AS time, temperature, humidity, pressure, pm25, light FROM streamed
       ORDER BY inserted_at DESC, id DESC LIMIT 100""",
)
def dash_series_100(spark, sf_dir):
    return streamed(spark, sf_dir).transform(dashboards.all_series)


def _series(metric: str):
    sql = f"SELECT inserted_at AS time, {metric} FROM streamed ORDER BY inserted_at DESC, id DESC LIMIT 100"

    @registered(f"dash_series_100_{metric}", sql)
    def series(spark, sf_dir):
        return streamed(spark, sf_dir).transform(dashboards.series, metric)


for _metric in ("temperature", "humidity", "pressure", "light", "pm25"):
    _series(_metric)


@registered(
    "dash_latest_15",
    """SELECT inserted_at AS "Tiempo", sensor_id AS "Sensor", round(temperature, 1) AS "Temp",
       round(humidity, 1) AS "Hum", round(pressure, 1) AS "Pres", light AS "Luz", round(pm25, 1) AS "PM25"
       FROM streamed ORDER BY inserted_at DESC, id DESC LIMIT 15""",
)
def dash_latest_15(spark, sf_dir):
    return streamed(spark, sf_dir).transform(dashboards.newest_table)


@registered(
    "latest_5",
    """SELECT sensor_id, round(temperature, 1) AS temperature, round(humidity, 1) AS humidity,
       round(pressure, 1) AS pressure, inserted_at FROM streamed ORDER BY inserted_at DESC, id DESC LIMIT 5""",
)
def latest_5(spark, sf_dir):
    return streamed(spark, sf_dir).transform(dashboards.newest_sample)


@registered("latest_100_full", f'SELECT {STREAMED} FROM streamed ORDER BY "timestamp" DESC, id DESC LIMIT 100')
def latest_100_full(spark, sf_dir):
    return streamed(spark, sf_dir).transform(latest.newest_full_rows, 100, "timestamp")


@registered("latest_10_full", f"SELECT {STREAMED} FROM streamed ORDER BY inserted_at DESC, id DESC LIMIT 10")
def latest_10_full(spark, sf_dir):
    return streamed(spark, sf_dir).transform(latest.newest_full_rows, 10)


@registered(
    "page_offset_limit",
    f'SELECT {READING} FROM readings ORDER BY "timestamp" DESC, id DESC LIMIT 100 OFFSET 200',
)
def page_offset_limit(spark, sf_dir):
    return readings(spark, sf_dir).transform(latest.page, 200, 100)


@registered(
    "page_offset_deep",
    f"""SELECT {READING} FROM (SELECT *, row_number() OVER (ORDER BY "timestamp" DESC, id DESC) - 1 AS place FROM readings)
       WHERE place >= (SELECT count(*) // 2 FROM readings) AND place < (SELECT count(*) // 2 FROM readings) + 100""",
)
def page_offset_deep(spark, sf_dir):
    df = readings(spark, sf_dir)
    index = latest.page_index(df)
    return latest.indexed_page(df, index, df.count() // 2, 100)


KEYSET_MARK = f"""mark AS (SELECT "timestamp" AS t, id AS i FROM readings
    WHERE "timestamp" < TIMESTAMP '{HALFWAY}' ORDER BY "timestamp" DESC, id DESC LIMIT 1)"""


@registered(
    "page_keyset_100",
    f"""SELECT {READING} FROM readings, mark WHERE "timestamp" > t OR ("timestamp" = t AND id > i)
       ORDER BY "timestamp", id LIMIT 100""",
    KEYSET_MARK,
)
def page_keyset_100(spark, sf_dir):
    df = readings(spark, sf_dir)
    stored = df.filter(F.col("timestamp") < halfway())
    mark_time = stored.agg(F.max("timestamp")).scalar()
    mark_id = stored.agg(F.max_by("id", F.struct("timestamp", "id"))).scalar()
    return df.transform(latest.page_after, mark_time, mark_id)


@registered(
    "src_latest_n_batches",
    f"""SELECT {STREAMED} FROM streamed WHERE batch_id IN (
         SELECT batch_id FROM streamed GROUP BY batch_id ORDER BY max(ingestion_timestamp) DESC, batch_id DESC LIMIT 8)""",
)
def src_latest_n_batches(spark, sf_dir):
    return streamed(spark, sf_dir).transform(latest.newest_batches)


@registered(
    "src_latest_snapshot",
    """SELECT date_trunc('day', "timestamp") AS generated_at, sensor_id, count(*) AS readings,
       round(avg(temperature) + 1e-9, 6) AS avg_temperature FROM readings
       WHERE date_trunc('day', "timestamp") = (SELECT max(date_trunc('day', "timestamp")) FROM readings)
       GROUP BY ALL""",
)
def src_latest_snapshot(spark, sf_dir):
    daily = readings(spark, sf_dir).withColumn("generated_at", F.date_trunc("DAY", "timestamp").cast("timestamp_ntz"))
    snapshots = daily.groupBy("generated_at", "sensor_id").agg(
        F.count(F.lit(1)).alias("readings"), F.avg("temperature").alias("avg_temperature")
    )
    return six(snapshots.transform(latest.newest_snapshot))


@registered(
    "src_jdbc_paged",
    """SELECT id // 1000 AS page, count(*) AS readings, min(id) + 1 AS first_id, max(id) + 1 AS last_id
       FROM readings GROUP BY 1""",
)
def src_jdbc_paged(spark, sf_dir):
    source = readings(spark, sf_dir).transform(as_source)
    return (
        source.transform(latest.id_pages)
        .groupBy("page")
        .agg(F.count(F.lit(1)).alias("readings"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    )
