"""Reading a JSON topic. The Kafka connector package must be on the class path to run it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str, topic: str, max_per_trigger: int | None = None, starting: str = "earliest"
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A stream of message texts."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()
    return stream.select(F.col("value").cast("string").alias("value"))
