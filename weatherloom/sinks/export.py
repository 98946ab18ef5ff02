"""Exports for other consumers: CSV, JSON, and versioned Parquet copies."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.functions import times

VERSION = "export_ts"
VERSION_FORMAT = "%Y%m%d_%H%M%S"


def to_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, in as many files as the data has partitions."""
    df.write.mode("overwrite").option("header", True).options(**times.ISO_TEXT).csv(path)


def to_json(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    df.write.mode("overwrite").options(**times.ISO_TEXT).json(path)


def versioned(df: DataFrame, root: str, at: datetime | None = None) -> str:
    """Write a copy under its export time; older copies stay as history."""
    path = f"{root}/{VERSION}={(at or datetime.now()).strftime(VERSION_FORMAT)}"
    df.write.mode("overwrite").parquet(path)
    return path


def latest_version(spark: SparkSession, root: str) -> DataFrame:
    """The newest copy. Only its folder is read."""
    copies = spark.read.parquet(root)
    newest = copies.agg(F.max(VERSION)).scalar()
    return copies.filter(F.col(VERSION) == newest).drop(VERSION)
