"""Declared schemas, and the one place where names and missing values are settled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("pressure", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("pm25", T.DoubleType()),
        T.StructField("light", T.DoubleType()),
        T.StructField("uv_level", T.IntegerType()),
        T.StructField("rain_raw", T.IntegerType()),
        T.StructField("wind_raw", T.IntegerType()),
        T.StructField("vibration", T.BooleanType()),
        T.StructField("location", T.StringType()),
    ]
)

BRONZE = T.StructType(
    SOURCE.fields
    + [
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

KPI_LONG = T.StructType(
    [
        T.StructField("kpi_name", T.StringType()),
        T.StructField("kpi_category", T.StringType()),
        T.StructField("kpi_value", T.DoubleType()),
        T.StructField("kpi_unit", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("generated_at", T.TimestampType()),
    ]
)

COMMIT = T.StructType([T.StructField("version", T.LongType())])

MARK = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("mark_id", T.LongType()),
        T.StructField("mark_timestamp", T.TimestampType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)

#: Each type can hold what the ones before it hold.
_WIDENED = ([T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()], [T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()], [T.FloatType(), T.DoubleType()])


def union_of(one: T.StructType, other: T.StructType) -> T.StructType:
    """The columns of either, all nullable; of two widths of a number the wider."""
    found = {f.name: f.dataType for f in one.fields}
    for f in other.fields:
        known = found.setdefault(f.name, f.dataType)
        if known != f.dataType:
            line = next((w for w in _WIDENED if known in w and f.dataType in w), None)
            if line is None:
                raise ValueError(f"column {f.name} was {known.simpleString()} and is now {f.dataType.simpleString()}")
            found[f.name] = max(known, f.dataType, key=line.index)
    return T.StructType([T.StructField(name, kind) for name, kind in found.items()])


TIMESTAMP_TYPES = (T.TimestampType, T.TimestampNTZType)


def has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating-point column.

    Done once on ingest: afterwards a missing value has one form, and means,
    extremes and counts skip it.
    """
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.expr(f"CASE WHEN NOT isnan(`{c}`) THEN `{c}` END") for c in floating}) if floating else df


def with_sensor_id(df: DataFrame) -> DataFrame:
    """Give a frame that only has ``ip`` the canonical ``sensor_id`` as well."""
    if has(df, "ip") and not has(df, "sensor_id"):
        return df.withColumn("sensor_id", F.col("ip"))
    return df


def timestamp_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TIMESTAMP_TYPES)]
