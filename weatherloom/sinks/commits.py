"""A log of commits: what a table consists of is what the newest commit says.

Each commit is one row in a folder of its own and holds the whole state, so that only the
newest one is ever needed. Rows, files or folders that no commit names are not
part of the table: a write that fails before its commit changes nothing.
One writer at a time for each key.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weatherloom.sinks import storage
from weatherloom.sources import files

SCHEMA = "key string, sequence bigint, state string, committed_at timestamp"
KEPT = 10


@dataclass(frozen=True)
class Commit:
    key: str
    sequence: int = 0
    state: dict = field(default_factory=dict)


def newest(spark: SparkSession, log: str) -> dict[str, Commit]:
    """The newest commit of each key."""
    rows = files.parquet_or_empty(spark, log, spark.createDataFrame([], SCHEMA).schema)
    last = rows.groupBy("key").agg(F.max_by(F.struct("sequence", "state"), "sequence").alias("c"))
    return {r["key"]: Commit(r["key"], r["c"]["sequence"], json.loads(r["c"]["state"])) for r in last.collect()}


def newest_of(spark: SparkSession, log: str, key: str) -> Commit:
    """The newest commit of ``key``, or an empty one numbered 0."""
    return newest(spark, log).get(key, Commit(key))


def commit(spark: SparkSession, log: str, before: Commit, state: dict) -> Commit:
    """Make ``state`` the newest one after ``before``; now and then old commits are removed."""
    after = Commit(before.key, before.sequence + 1, state)
    row = spark.range(1).select(
        F.lit(after.key).alias("key"),
        F.lit(after.sequence).cast("bigint").alias("sequence"),
        F.lit(json.dumps(state)).alias("state"),
        F.current_timestamp().alias("committed_at"),
    )
    row.write.mode("overwrite").parquet(f"{log}/of={after.key}/number={after.sequence}")
    if after.sequence % KEPT == 0:
        storage.remove_partitions(spark, f"{log}/of={after.key}", "number", lambda n: int(n) <= after.sequence - KEPT)
    return after
