"""Table to topic: bronze files as a stream of formatted messages, and the time mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weatherloom import schemas
from weatherloom.functions import times
from weatherloom.operators import project
from weatherloom.sinks import topics
from weatherloom.sources import files
from weatherloom.streaming import run

POLL_SECONDS = 10
FIRST_LOOK_BACK = "1 HOUR"


def messages(readings: DataFrame) -> DataFrame:
    """Readings as keyed JSON messages."""
    return readings.transform(project.stream_record).transform(project.as_messages)


def to_kafka(readings: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Send new readings every few seconds. The checkpoint replaces a stored mark."""
    writer = messages(readings).writeStream.format("kafka").options(**topics.kafka_options(servers, topic))
    return writer.option("checkpointLocation", checkpoint).trigger(**run.every(POLL_SECONDS)).start()


def to_files(readings: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The same messages as lines of text files."""
    return run.to_files(messages(readings).select("value"), path, checkpoint, trigger, fmt="text")


def commit_time_mark(batch: DataFrame, path: str, source: str, stream: str, epoch: int) -> None:
    """Write how far a micro-batch reached: its newest (timestamp, id)."""
    newest = batch.orderBy(F.desc("timestamp"), F.desc("id")).limit(1)
    row = newest.select(
        F.lit(source).alias("source"),
        F.col("id").cast("bigint").alias("mark_id"),
        F.col("timestamp").cast("timestamp").alias("mark_timestamp"),
        F.current_timestamp().alias("committed_at"),
    )
    row.write.mode("overwrite").parquet(f"{path}/stream={stream}/epoch={epoch}")


def last_time_mark(spark: SparkSession, path: str, source: str, now=None) -> DataFrame:
    """The newest mark of ``source``; without one, an hour ago."""
    marks = files.parquet_or_empty(spark, path, schemas.MARK).filter(F.col("source") == source)
    newest = marks.agg(F.max(F.struct("mark_timestamp", "mark_id")).alias("m"))
    start = times.before(times.moment(now), FIRST_LOOK_BACK)
    return newest.select(
        F.lit(source).alias("source"),
        F.coalesce(F.col("m.mark_timestamp"), start).alias("mark_timestamp"),
        F.col("m.mark_id").alias("mark_id"),
    )
