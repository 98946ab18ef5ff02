"""Summaries of a layer: contents, quality, what cleaning removed, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom.functions import ladders
from weatherloom.operators import combine, duplicates, filters, groupstats

READABLE_TIME = "yyyy-MM-dd HH:mm:ss"


def silver(df: DataFrame) -> DataFrame:
    """Contents of the cleaned layer as one row with three nested groups."""
    score = F.col("data_quality_score")
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("sensor_id").alias("unique_sensors"),
        F.struct(
            F.date_format(F.min("timestamp"), READABLE_TIME).alias("start"),
            F.date_format(F.max("timestamp"), READABLE_TIME).alias("end"),
        ).alias("date_range"),
        F.struct(
            F.avg(score).alias("avg_quality_score"),
            F.count_if(score == V.COMPLETE_QUALITY).alias("complete_records"),
        ).alias("data_quality"),
        F.struct(*[F.avg(c).alias(f"avg_{c}") for c in V.MEDIAN_IMPUTED_COLUMNS]).alias("sensor_stats"),
    )


def by_quality_score(df: DataFrame) -> DataFrame:
    return df.groupBy("data_quality_score").count().orderBy("data_quality_score")


def by_comfort_index(df: DataFrame) -> DataFrame:
    """Readings, sensors and climate of each comfort class."""
    return df.groupBy("comfort_index").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_distinct("sensor_id").alias("sensors"),
        F.avg("temperature").alias("avg_temperature"),
        F.avg("humidity").alias("avg_humidity"),
    )


def quality(df: DataFrame) -> DataFrame:
    """Mean score, high-quality readings, their share, and the state that share means."""
    high = F.count_if(F.col("data_quality_score") >= V.HIGH_QUALITY)
    one = df.agg(
        F.avg("data_quality_score").alias("avg_quality"),
        high.alias("high_quality_readings"),
        F.try_divide(100.0 * high, F.count(F.lit(1))).alias("high_quality_percent"),
    )
    return one.withColumn("system_status", ladders.system_status(F.col("high_quality_percent")))


def cleaning(df: DataFrame, column: str = "temperature", population: bool = False) -> DataFrame:
    """Rows in, duplicates and outliers removed, rows out, and the share kept.

    Everything comes from one grouping of the input: the count of copies gives
    the rows in, so the input is not read again. The bounds ask for that count
    too, which lets both uses share the same shuffle.
    """
    distinct = duplicates.with_copies(df)
    bounds = filters.sigma_bounds(column, V.OUTLIER_SIGMAS, population)
    bounded = groupstats.with_global(distinct, "_bounds", *bounds, F.sum("copies").alias("rows_in"))
    counts = bounded.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in"),
        F.count(F.lit(1)).alias("rows_distinct"),
        F.count_if(filters.within_bounds(F.col(column), F.col("_bounds"))).alias("rows_out"),
    )
    return counts.select(
        "rows_in",
        (F.col("rows_in") - F.col("rows_distinct")).alias("duplicates_removed"),
        (F.col("rows_distinct") - F.col("rows_out")).alias("outliers_removed"),
        "rows_out",
        F.try_divide(100.0 * F.col("rows_out"), F.col("rows_in")).alias("percent_kept"),
    )


def layers(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files and rows of each layer. Reads no data columns."""
    frames = [
        spark.read.option("recursiveFileLookup", True)
        .parquet(path)
        .select(F.lit(layer).alias("layer"), F.col("_metadata.file_path").alias("file"))
        for layer, path in paths.items()
    ]
    return (
        combine.by_name(*frames)
        .groupBy("layer")
        .agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("readings"))
    )
