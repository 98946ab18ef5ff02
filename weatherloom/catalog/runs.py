"""Cleaning chains and whole jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from weatherloom.catalog.aggregates import long_table_sql, sensor_statistics_sql, wide_sql
from weatherloom.catalog.readings import as_source, readings, readings_raw
from weatherloom.catalog.registry import COMFORT_INDEX, QUALITY_SCORE, SENSOR_CATEGORY, no_zone, registered, six
from weatherloom.catalog.rows import MEAN_FILLED, MEANS, VALID_SQL, halfway, sigma_views
from weatherloom.operators import filters, kpis
from weatherloom.plans import cleaning, jobs
from weatherloom.session import scratch_path
from weatherloom.sinks import export, lake
from weatherloom.sinks.lake import Lake

RANGE_VIEWS = (
    f"""valid AS (SELECT *, {QUALITY_SCORE} AS score FROM newest_per_key
        WHERE sensor_id IS NOT NULL AND "timestamp" IS NOT NULL AND {VALID_SQL})""",
    """valid_medians AS (SELECT quantile_disc(temperature, 0.5) AS mt, quantile_disc(humidity, 0.5) AS mh,
        quantile_disc(pressure, 0.5) AS mp FROM valid)""",
    f"""range_silver AS (SELECT *, temperature * 1.8 + 32 AS temperature_fahrenheit, {COMFORT_INDEX} AS comfort_index,
        {SENSOR_CATEGORY} AS sensor_category FROM (
          SELECT id, sensor_id, coalesce(temperature, mt) AS temperature, coalesce(humidity, mh) AS humidity,
            coalesce(pressure, mp) AS pressure, "timestamp", pm25, light, coalesce(location, 'Unknown') AS location,
            ingestion_timestamp, score AS data_quality_score FROM valid, valid_medians))""",
)


@registered(
    "job_clean_range",
    """SELECT id, sensor_id, round(temperature + 1e-9, 6) AS temperature, humidity, pressure, "timestamp", pm25, light,
       location, ingestion_timestamp, data_quality_score, round(temperature_fahrenheit + 1e-9, 6) AS temperature_fahrenheit,
       comfort_index, sensor_category FROM range_silver""",
    *RANGE_VIEWS,
)
def job_clean_range(spark, sf_dir):
    cleaned = readings_raw(spark, sf_dir).transform(cleaning.by_range, stage=scratch_path(spark, "distinct"))
    return six(cleaned, "temperature", "temperature_fahrenheit")


GAPS_OR_VALID = """(temperature IS NULL OR temperature BETWEEN -50 AND 70) AND (humidity IS NULL OR humidity BETWEEN 0 AND 100)
    AND (pressure IS NULL OR pressure BETWEEN 800 AND 1200)"""


@registered(
    "job_clean_range_keep",
    """SELECT id, sensor_id, round(temperature + 1e-9, 6) AS temperature, humidity, pressure, "timestamp", pm25, light,
       location, ingestion_timestamp, data_quality_score, round(temperature_fahrenheit + 1e-9, 6) AS temperature_fahrenheit,
       comfort_index, sensor_category FROM range_silver""",
    *(view.replace(VALID_SQL, GAPS_OR_VALID) for view in RANGE_VIEWS),
)
def job_clean_range_keep(spark, sf_dir):
    stage = scratch_path(spark, "distinct")
    cleaned = readings_raw(spark, sf_dir).transform(cleaning.by_range, nulls="keep", stage=stage)
    return six(cleaned, "temperature", "temperature_fahrenheit")


@registered(
    "job_clean_sigma",
    f"""SELECT id, sensor_id, {MEAN_FILLED}, "timestamp", location, ingestion_timestamp FROM kept, means""",
    *sigma_views("distinct_raw", "stddev_samp"),
    MEANS.format("kept"),
)
def job_clean_sigma(spark, sf_dir):
    return six(readings_raw(spark, sf_dir).transform(cleaning.by_sigma, stage=scratch_path(spark, "distinct")))


@registered(
    "job_clean_notebook",
    """SELECT id, sensor_id, sensor_id AS ip, round(coalesce(temperature, nullif(t, 0)) + 1e-9, 6) AS temperature,
       round(coalesce(humidity, nullif(h, 0)) + 1e-9, 6) AS humidity, round(coalesce(pressure, nullif(p, 0)) + 1e-9, 6) AS pressure,
       round(coalesce(pm25, nullif(q, 0)) + 1e-9, 6) AS pm25, round(coalesce(light, nullif(l, 0)) + 1e-9, 6) AS light, "timestamp",
       location, ingestion_timestamp, CAST(year("timestamp") AS int) AS year, CAST(month("timestamp") AS int) AS month,
       CAST(day("timestamp") AS int) AS day, CAST(hour("timestamp") AS int) AS hour FROM kept, means""",
    "filled_raw AS (SELECT * FROM distinct_raw WHERE sensor_id IS NOT NULL AND temperature IS NOT NULL)",
    *sigma_views("filled_raw", "stddev_pop"),
    MEANS.format("kept"),
)
def job_clean_notebook(spark, sf_dir):
    renamed = readings_raw(spark, sf_dir).withColumnRenamed("sensor_id", "ip")
    return six(renamed.transform(cleaning.by_sigma_with_times, stage=scratch_path(spark, "distinct")))


# The source of the jobs: the canonical columns; correction rows are only in the raw one.
JOB_SOURCE = """source AS (SELECT DISTINCT id + 1 AS id, sensor_id, temperature, humidity, pressure, "timestamp",
    pm25, light, 'Unknown' AS location FROM {0})"""
JOB_SILVER = (
    *sigma_views("source", "stddev_samp"),
    MEANS.format("kept"),
    """silver AS (SELECT id, sensor_id, "timestamp", location, coalesce(temperature, t) AS temperature,
        coalesce(humidity, h) AS humidity, coalesce(pressure, p) AS pressure, coalesce(pm25, q) AS pm25,
        coalesce(light, l) AS light FROM kept, means)""",
)


@registered("job_initial", sensor_statistics_sql("silver"), JOB_SOURCE.format("readings_raw"), *JOB_SILVER)
def job_initial(spark, sf_dir):
    store = Lake(scratch_path(spark, "initial-job"))
    jobs.initial(readings_raw(spark, sf_dir).transform(as_source), store)
    return six(lake.read_snapshot(spark, store.gold_table(jobs.SENSORS)))


@registered("job_incremental", wide_sql("silver"), JOB_SOURCE.format("readings"), *JOB_SILVER)
def job_incremental(spark, sf_dir):
    store = Lake(scratch_path(spark, "incremental-job"))
    source = readings(spark, sf_dir).transform(as_source)
    jobs.incremental(source.filter(F.col("timestamp") < halfway()), store)
    jobs.incremental(source, store)
    wide = lake.read_snapshot(spark, store.gold_table(jobs.WIDE)).drop("timestamp", "generation_time")
    return six(wide)


@registered(
    "job_full",
    long_table_sql("range_job"),
    JOB_SOURCE.format("readings"),
    f"""range_job AS (SELECT *, {QUALITY_SCORE} AS data_quality_score FROM source WHERE {VALID_SQL})""",
)
def job_full(spark, sf_dir):
    store = Lake(scratch_path(spark, "full-job"))
    source = readings(spark, sf_dir).transform(as_source)
    newest = source.transform(filters.valid_range).agg(F.max("timestamp")).scalar()
    jobs.full(source, store, method="range", as_of=newest, at=datetime(2024, 2, 1))
    exported = export.latest_version(spark, f"{store.exports}/kpis")
    return six(exported.drop("generated_at"))


@registered("job_export", wide_sql("silver"), JOB_SOURCE.format("readings"), *JOB_SILVER)
def job_export(spark, sf_dir):
    store = Lake(scratch_path(spark, "export-job"))
    jobs.initial(readings(spark, sf_dir).transform(as_source), store)
    jobs.export_tables(spark, store)
    csv = f"{store.exports}/csv"
    exported = spark.read.schema(jobs.silver_of(spark, store).schema).option("header", True).csv(f"{csv}/readings")
    return six(exported.transform(kpis.wide))
