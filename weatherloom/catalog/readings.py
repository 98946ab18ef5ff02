"""The given ``events`` table in the role of sensor readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weatherloom import schemas
from weatherloom.operators import project

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a pattern, so that the table may be one file or a folder of files
    return reader.parquet(f"{sf_dir}/events.parquet*")


def as_readings(df: DataFrame) -> DataFrame:
    """Readings with some missing values."""
    readings = df.selectExpr(
        "event_id AS id",
        """concat(CASE user_id % 4 WHEN 0 THEN 'TEMP_' WHEN 1 THEN 'HUM_' WHEN 2 THEN 'PRES_' ELSE '10.0.0.' END,
                  lpad(CAST(user_id AS string), 6, '0')) AS sensor_id""",
        "CASE WHEN event_id % 37 <> 0 THEN value - 20 END AS temperature",
        "CASE WHEN event_id % 41 <> 0 THEN CAST(get_json_object(props, '$.k') AS double) END AS humidity",
        "CASE WHEN event_id % 43 <> 0 THEN 780 + CAST(event_id * 7919 % 50000 AS double) / 100 END AS pressure",
        "ts AS timestamp",
        "value AS pm25",
        "CAST(event_id * 31 % 2500 AS int) AS light",
        "CASE WHEN event_id % 53 <> 0 THEN event_type END AS location",
        "ts + INTERVAL 1 HOUR AS ingestion_timestamp",
    )
    return schemas.nan_to_null(readings)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(events(spark, sf_dir))


def as_readings_raw(df: DataFrame) -> DataFrame:
    """Readings with exact copies of some and late corrections of others.

    Each reading is turned into its versions in place, so the table is read once.
    """
    versions = df.selectExpr(
        "*",
        """explode(concat(array(0), if(id % 100 = 0, array(0), array()),
                          if(id % 97 = 0, array(1), array()))) AS version""",
    )
    return versions.selectExpr(
        "id + version * 1000000000 AS id",
        "sensor_id",
        "temperature + version AS temperature",
        "humidity",
        "pressure",
        "timestamp",
        "pm25",
        "light",
        "location",
        "if(version = 1, ingestion_timestamp + INTERVAL 1 HOUR, ingestion_timestamp) AS ingestion_timestamp",
    )


def readings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings_raw(readings(spark, sf_dir))


def as_all_columns(df: DataFrame) -> DataFrame:
    """Add the columns that only pass through, and the arrival time."""
    return df.selectExpr(
        "*",
        "CAST(id * 17 % 16 AS int) AS uv_level",
        "CAST(id * 13 % 801 AS int) AS rain_raw",
        "CAST(id * 11 % 401 AS int) AS wind_raw",
        "id % 5 = 0 AS vibration",
        "concat('batch_', date_format(date_trunc('DAY', ingestion_timestamp), 'yyyyMMdd_HHmmss')) AS batch_id",
        "ingestion_timestamp AS inserted_at",
    )


def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of streamed readings: every reading column plus ``inserted_at``."""
    return as_all_columns(readings(spark, sf_dir))


def as_source(df: DataFrame) -> DataFrame:
    """The shape of the source database table.

    ``ip`` instead of ``sensor_id``, no location, and a serial id that starts at 1.
    """
    return as_all_columns(df).selectExpr(
        "id + 1 AS id",
        "sensor_id AS ip",
        "temperature",
        "humidity",
        "pressure",
        "CAST(timestamp AS timestamp) AS timestamp",
        "pm25",
        "light",
        "uv_level",
        "rain_raw",
        "wind_raw",
        "vibration",
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with quality score and derived measures."""
    return readings(spark, sf_dir).transform(project.quality_score).transform(project.derived_measures)
