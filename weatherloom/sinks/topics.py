"""Writing readings to a JSON topic. Needs the Kafka connector package at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame

from weatherloom.operators import project


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Send the rows of a batch frame, one message each, keyed by sensor."""
    project.as_messages(df).write.format("kafka").options(**kafka_options(servers, topic)).save()
