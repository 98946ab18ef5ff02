"""File streams: the same transformations as for a topic, over files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def reading_files(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files below ``path`` as a stream; ``files_per_batch`` limits one micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def message_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of text files as a stream of messages in ``value``."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)
