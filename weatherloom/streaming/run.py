"""Starting streams: triggers, file output, micro-batch functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

DRAIN = {"availableNow": True}


def every(seconds: int) -> dict[str, str]:
    return {"processingTime": f"{seconds} seconds"}


def to_files(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, fmt: str = "parquet"
) -> StreamingQuery:
    """Append a stream to files; each micro-batch is recorded once."""
    writer = df.writeStream.format(fmt).outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or DRAIN)).start(path)


def per_batch(
    df: DataFrame,
    action: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Hand each micro-batch to ``action``, which must be safe to repeat for the same number."""
    writer = df.writeStream.outputMode(mode).foreachBatch(action)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or DRAIN)).start()
