"""Audit rows: what each run read, removed and wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.functions import times

COMPLETED = "completed"


def cleaning_row(metrics: DataFrame, script: str, output_file: str, at: Column | None = None) -> DataFrame:
    """The audit row of a cleaning run from its metrics (see ``summary.cleaning``)."""
    return metrics.select(
        F.lit(script).alias("script"),
        times.moment(at).alias("execution_time"),
        F.col("rows_out").alias("records_processed"),
        "duplicates_removed",
        "outliers_removed",
        F.lit(output_file).alias("output_file"),
        F.lit(COMPLETED).alias("status"),
    )


def kpi_row(
    wide: DataFrame, sensors: DataFrame, script: str, outputs: list[str], at: Column | None = None
) -> DataFrame:
    """The audit row of a KPI run from its wide row and its sensor table."""
    n_sensors = sensors.agg(F.count(F.lit(1))).scalar()
    return wide.select(
        F.lit(script).alias("script"),
        times.moment(at).alias("execution_time"),
        F.lit(len([c for c in wide.columns if c != "alerts_json"])).alias("kpis_generated"),
        n_sensors.alias("sensors_analyzed"),
        F.array(*[F.lit(o) for o in outputs]).alias("output_files"),
        "temperature_avg",
        F.col("air_quality_category").alias("air_quality"),
        F.col("unique_sensors").alias("total_sensors"),
        F.lit(COMPLETED).alias("status"),
    )


def append(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
