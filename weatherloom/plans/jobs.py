"""The bronze-silver-gold jobs.

Each layer is one declarative plan that ends in a write; the next layer starts
from the written table, so a lost executor never sends a job back beyond the
layer it is working on.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom import schemas
from weatherloom.functions import times
from weatherloom.operators import kpis, latest, sensors
from weatherloom.plans import cleaning, increments
from weatherloom.session import cut_lineage
from weatherloom.sinks import audit, commits, export, lake, storage
from weatherloom.sinks.lake import Lake

WIDE, SENSORS, LONG = "kpis", "sensor_statistics", "kpis_long"
CLEANING_SCRIPT, KPI_SCRIPT = "silver_cleaning", "gold_kpis"
METHODS = {"sigma": cleaning.by_sigma, "range": cleaning.by_range, "range_keep": partial(cleaning.by_range, nulls="keep")}


def bronze_to_silver(
    spark: SparkSession, store: Lake, method: str = "sigma", newest_batches: int | None = None, at=None
) -> DataFrame:
    """Clean the bronze readings into the silver snapshot and return it.

    ``newest_batches`` limits the input to the batches that arrived last.
    ``range_keep`` is the range chain that keeps readings with gaps, so that the
    quality score tells them apart and medians fill them.
    """
    if method == "sigma" and newest_batches is None:
        return _silver_by_increments(spark, store, at)
    bronze = lake.read_bronze(spark, store).transform(schemas.with_sensor_id).transform(schemas.nan_to_null)
    if newest_batches is not None:
        bronze = bronze.transform(latest.newest_batches, newest_batches)
    if method not in METHODS:
        raise ValueError(f"method must be one of {sorted(METHODS)}")
    staging = store.staging_of(uuid.uuid4().hex)
    cleaned = METHODS[method](bronze, stage=staging)
    lake.write_snapshot(cleaned, store.silver)
    commits.commit(spark, increments.log_of(store), increments.state_of(spark, store), {})  # silver is the snapshot now

    silver = lake.read_snapshot(spark, store.silver)
    distinct = spark.read.parquet(staging)
    # counts of written tables come from their file footers
    rows_in, rows_distinct, rows_out = (t.count() for t in (bronze, distinct, silver))
    metrics = spark.range(1).select(
        F.lit(rows_out).alias("rows_out"),
        F.lit(rows_in - rows_distinct).alias("duplicates_removed"),
        F.lit(rows_distinct - rows_out).alias("outliers_removed"),
    )
    audit.append(audit.cleaning_row(metrics, CLEANING_SCRIPT, store.silver, times.moment(at)), f"{store.audit}/silver")
    storage.remove(spark, staging)
    return silver


def _silver_by_increments(spark: SparkSession, store: Lake, at) -> DataFrame:
    """The sigma chain over the batches that are new; its counts come from the state."""
    state = increments.clean(spark, store)
    silver = silver_of(spark, store)
    rows_out, rows_distinct = state.get("rows_out", 0), state.get("rows_distinct", 0)
    metrics = spark.range(1).select(
        F.lit(rows_out).cast("bigint").alias("rows_out"),
        F.lit(state["rows_in"] - rows_distinct).cast("bigint").alias("duplicates_removed"),
        F.lit(rows_distinct - rows_out).cast("bigint").alias("outliers_removed"),
    )
    audit.append(audit.cleaning_row(metrics, CLEANING_SCRIPT, store.silver, times.moment(at)), f"{store.audit}/silver")
    return silver


def silver_of(spark: SparkSession, store: Lake) -> DataFrame:
    """The cleaned readings: those of the increments, or the snapshot where it is newer."""
    rows = increments.silver(spark, store)
    return lake.read_snapshot(spark, store.silver) if rows is None else rows


def silver_to_gold(spark: SparkSession, store: Lake, as_of=None, at=None) -> None:
    """Write the wide KPI row, the sensor statistics and the long KPI table.

    Silver is scanned once, into parts per sensor and location; the three tables come from these.
    """
    held = cut_lineage(silver_of(spark, store).transform(kpis.parts, as_of))
    at = times.moment(at)
    lake.write_snapshot(held.transform(kpis.wide_of_parts).transform(kpis.stamped, at), store.gold_table(WIDE))
    lake.write_snapshot(held.transform(sensors.statistics_of_parts), store.gold_table(SENSORS))
    lake.write_snapshot(held.transform(kpis.long_of_parts, at), store.gold_table(LONG))
    row = audit.kpi_row(
        lake.read_snapshot(spark, store.gold_table(WIDE)).drop("timestamp", "generation_time"),
        lake.read_snapshot(spark, store.gold_table(SENSORS)),
        KPI_SCRIPT,
        [WIDE, SENSORS, LONG],
        at,
    )
    audit.append(row, f"{store.audit}/gold")


def export_tables(spark: SparkSession, store: Lake, names=("kpis", "readings")) -> None:
    """Tables of the lake as CSV: ``kpis``, ``readings``, ``sensor_statistics``, ``log``."""
    paths = {
        "kpis": store.gold_table(WIDE),
        "readings": store.silver,
        "sensor_statistics": store.gold_table(SENSORS),
        "log": f"{store.audit}/gold",
    }
    for name in names:
        if name == "readings":
            df = silver_of(spark, store)
        else:
            df = spark.read.parquet(paths[name]) if name == "log" else lake.read_snapshot(spark, paths[name])
        if name == "log":
            df = df.withColumn("output_files", F.array_join("output_files", " "))
        export.to_csv(df, f"{store.exports}/csv/{name}")


def export_kpis(spark: SparkSession, store: Lake, at: datetime | None = None) -> str:
    """A versioned copy of the newest long KPIs."""
    newest = latest.newest_snapshot(lake.read_snapshot(spark, store.gold_table(LONG)))
    return export.versioned(newest, f"{store.exports}/kpis", at)


def initial(
    source: DataFrame,
    store: Lake,
    method: str = "sigma",
    as_of=None,
    page_size: int = V.PAGE_SIZE,
    up_to: int | None = None,
) -> None:
    """Load everything, clean it, compute the KPIs."""
    spark = source.sparkSession
    lake.initial_load(source, store, page_size=page_size, up_to=up_to)
    bronze_to_silver(spark, store, method)
    silver_to_gold(spark, store, as_of)


def incremental(
    source: DataFrame,
    store: Lake,
    method: str = "sigma",
    as_of=None,
    newest_batches: int | None = None,
    up_to: int | None = None,
) -> None:
    """Add what is new since the mark, then clean and compute again."""
    spark = source.sparkSession
    lake.append_increment(source, store, up_to=up_to)
    bronze_to_silver(spark, store, method, newest_batches)
    silver_to_gold(spark, store, as_of)


def full(
    source: DataFrame,
    store: Lake,
    method: str = "sigma",
    as_of=None,
    newest_batches: int | None = None,
    at: datetime | None = None,
    up_to: int | None = None,
) -> str:
    """The incremental job followed by the versioned export; returns the export's path."""
    incremental(source, store, method, as_of, newest_batches, up_to)
    return export_kpis(source.sparkSession, store, at)
