"""Projections: canonical columns, ingest stamps, derived columns, stream records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom import schemas
from weatherloom.functions import ladders, measures, times
from weatherloom.operators import latest


def canonical(df: DataFrame) -> DataFrame:
    """The extraction column list: ``ip`` becomes ``sensor_id``, location is unknown."""
    kept = [c for c in V.SOURCE_COLUMNS if c not in ("sensor_id", "location") and c in df.columns]
    columns = {c: F.col(c) for c in kept}
    columns["sensor_id"] = F.col("ip" if schemas.has(df, "ip") else "sensor_id")
    columns["location"] = F.lit(V.UNKNOWN_LOCATION)
    return df.select(*[columns[c].alias(c) for c in V.SOURCE_COLUMNS if c in columns])


def ingest_stamps(df: DataFrame, at: Column | None = None, batch_id: Column | None = None) -> DataFrame:
    """Add ``ingestion_timestamp`` and ``batch_id``; one instant serves the whole batch."""
    at = times.moment(at)
    return df.withColumns(
        {
            "ingestion_timestamp": at,
            "batch_id": times.batch_stamp(at) if batch_id is None else batch_id,
        }
    )


def initial_batch_ids(df: DataFrame, page_size: int = V.PAGE_SIZE, id_column: str = "id") -> DataFrame:
    """Name the batch of each row of a first load after its page of ids."""
    page = latest.page_number(df, page_size, id_column)
    return df.withColumn("batch_id", F.format_string(V.INITIAL_BATCH_PATTERN, page))


def quality_score(df: DataFrame) -> DataFrame:
    """Score each reading by the values it carries."""
    measured = (F.col(c) for c in ("temperature", "humidity", "pressure"))
    return df.withColumn("data_quality_score", measures.quality_score(*measured))


def derived_measures(df: DataFrame) -> DataFrame:
    """Fahrenheit, comfort and category of each reading."""
    t, h = F.col("temperature"), F.col("humidity")
    return df.withColumns(
        {
            "temperature_fahrenheit": measures.fahrenheit(t),
            "comfort_index": measures.comfort_index(t, h),
            "sensor_category": measures.sensor_category(F.col("sensor_id")),
        }
    )


def time_parts(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.withColumns(times.time_parts(F.col(column))) if schemas.has(df, column) else df


def processing_stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("processing_timestamp", F.current_timestamp())


def timestamps_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in schemas.timestamp_columns(df)})


def leading(df: DataFrame, *first: str) -> DataFrame:
    """Put some columns in front and keep the order of the rest."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def stream_record(df: DataFrame) -> DataFrame:
    """The ten fields of an outgoing message."""
    return df.select(
        F.col("timestamp"),
        F.col("sensor_id"),
        measures.sensor_name(F.col("sensor_id")).alias("sensor_name"),
        F.lit(V.STATION_NAME).alias("location"),
        *[F.round(F.col(c).cast("double"), 2).alias(c) for c in V.MEAN_IMPUTED_COLUMNS],
        ladders.air_quality_five(F.col("pm25")).alias("air_quality"),
    )


def as_messages(df: DataFrame, key: str = "sensor_id", keep_nulls: bool = False) -> DataFrame:
    """``key`` and JSON ``value``, as a topic wants them."""
    options = {"ignoreNullFields": str(not keep_nulls).lower(), **times.ISO_TEXT}
    value = F.to_json(F.struct(*df.columns), options)
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))
