"""Topic to table: decode, default, split off bad messages, append once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weatherloom.sinks import timeline
from weatherloom.streaming import decode, run

COUNTERS = "ingest"


def counted(rows: DataFrame) -> DataFrame:
    """Report received, inserted and rejected messages with the progress of each micro-batch."""
    return rows.observe(
        COUNTERS,
        F.count(F.lit(1)).alias("received"),
        F.count_if(~F.col("rejected")).alias("inserted"),
        F.count_if("rejected").alias("errors"),
    )


def counters(spark: SparkSession, table: str, stream: str | None = None) -> DataFrame:
    """One row of received, inserted and errors over all stored micro-batches, or those of one stream."""
    rows = timeline.stored(spark, table).filter(F.col("source_stream").isNotNull())
    rows = rows if stream is None else rows.filter(F.col("source_stream") == stream)
    return rows.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(~F.col(timeline.REJECTED)).alias("inserted"),
        F.count_if(timeline.REJECTED).alias("errors"),
    )


def quarantined(spark: SparkSession, table: str, stream: str | None = None) -> DataFrame:
    """The rejected messages, when they arrived and on which stream."""
    rows = timeline.stored(spark, table).filter(timeline.REJECTED)
    rows = rows if stream is None else rows.filter(F.col("source_stream") == stream)
    return rows.select("message", "inserted_at", "source_stream")


def start(messages: DataFrame, table: str, checkpoint: str, stream: str, trigger: dict | None = None) -> StreamingQuery:
    """Append readings and rejected messages to ``table``.

    Each micro-batch is decoded and written once; nothing is held in memory for a
    second pass. :func:`timeline.read` gives the readings, :func:`quarantined` the
    rejected messages and :func:`counters` their numbers. A restart after a failure adds no rows. ``stream``
    names the checkpoint's lineage: a stream begun anew needs a new name.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        kept = F.when(F.col(timeline.REJECTED), F.col("message"))
        rows = batch.withColumns({"message": kept, "source_stream": F.lit(stream)})
        timeline.write_epoch(rows, table, stream, epoch)

    return run.per_batch(counted(decode.decoded(messages)), store, checkpoint, trigger)
