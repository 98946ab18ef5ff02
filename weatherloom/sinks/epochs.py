"""Tables that a stream appends to one micro-batch at a time, and that are compacted.

::

    open/<by>=.../stream=.../epoch=...    rows of one micro-batch, as they came
    closed/<by>=.../run=...               rows of many micro-batches, written by a compaction

``by`` is the column that readers prune by, above stream and epoch, so that only
folders of the wanted months or days are listed. A micro-batch that is
delivered again first removes what its earlier delivery left, whichever values
of ``by`` that touched. A compaction writes new runs and then commits one row,
which says up to which epoch of each stream rows are closed and which runs
count. Readers go by that row, so rows are never seen twice or not at all;
the folders it makes superfluous are removed afterwards.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom.sinks import commits, storage

#: Runs of one value of ``by`` before a compaction writes them into one again.
RUNS = 8
#: What Spark calls the folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class EpochTable:
    """``order`` sorts rows inside files; ``fold`` merges rows that stand for parts of one result."""

    path: str
    by: str
    kind: str = "string"
    order: tuple[str, ...] = ()
    fold: Callable[[DataFrame], DataFrame] | None = None

    @property
    def open(self) -> str:
        return f"{self.path}/open"

    @property
    def closed(self) -> str:
        return f"{self.path}/closed"

    @property
    def log(self) -> str:
        return f"{self.path}/_log"

    def state(self, spark: SparkSession) -> commits.Commit:
        return commits.newest_of(spark, self.log, "table")

    def write(self, df: DataFrame, stream: str, epoch: int) -> None:
        """Store one micro-batch; a second delivery replaces the first."""
        for _, _, _, place in self._epochs(df.sparkSession, {}, (stream, epoch)):
            storage.remove(df.sparkSession, place)
        rows = _sorted(df.withColumns({"stream": F.lit(stream), "epoch": F.lit(epoch)}), self.by, *self.order)
        rows.write.mode("append").partitionBy(self.by, "stream", "epoch").parquet(self.open)

    def read(self, spark: SparkSession, values: set[str] | None = None, without: tuple[str, int] | None = None) -> DataFrame | None:
        """All rows, with ``by`` as a column; None if there are none.

        ``values`` opens the folders of some values of ``by`` only, ``without`` leaves out one micro-batch.
        """
        state = self.state(spark).state
        wanted = None if values is None else {f"{self.by}={v}" for v in values}
        opened = [
            place
            for value, stream, epoch, place in self._epochs(spark, state)
            if (wanted is None or value in wanted) and (stream, epoch) != without
        ]
        runs = {v: own for v, own in state.get("runs", {}).items() if wanted is None or v in wanted}
        parts = [self._rows(spark, self.open, opened)] if opened else []
        parts += [self._rows(spark, self.closed, self._runs(runs))] if runs else []
        return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts) if parts else None

    def _rows(self, spark: SparkSession, root: str, places: list[str]) -> DataFrame:
        rows = spark.read.option("basePath", root).parquet(*places).drop("stream", "epoch", "run")
        return rows.withColumn(self.by, F.col(self.by).cast(self.kind))

    def _runs(self, runs: dict[str, list[int]]) -> list[str]:
        return [f"{self.closed}/{value}/run={run}" for value, own in sorted(runs.items()) for run in own]

    def unsettled(self, spark: SparkSession) -> set[str]:
        """Values of ``by`` with open epochs or several runs; of the others each row is final."""
        state = self.state(spark).state
        found = {v for v, _, _, _ in self._epochs(spark, state)} | {v for v, own in state.get("runs", {}).items() if len(own) > 1}
        return {v.split("=", 1)[1] for v in found}

    def _epochs(self, spark: SparkSession, state: dict, only: tuple[str, int] | None = None) -> list[tuple[str, str, int, str]]:
        """Folder of ``by``, stream, epoch and place of every open micro-batch that is not closed yet."""
        up_to = state.get("up_to", {})
        out = []
        for place in storage.matching(spark, self.open, f"{self.by}=*/stream=*/epoch=*"):
            values = storage.values_of(place)
            stream, epoch = values["stream"], int(values["epoch"])
            if epoch > up_to.get(stream, -1) and only in (None, (stream, epoch)):
                out.append((place.split("/")[0], stream, epoch, f"{self.open}/{place}"))
        return out

    def compact(self, spark: SparkSession, all_epochs: bool = False, runs: int = RUNS) -> int:
        """Close the open epochs; how many were closed.

        The newest epoch of each stream stays open, as it may still be
        delivered again, unless ``all_epochs`` says that the streams have stopped.
        Where ``by`` has ``runs`` runs already, or a fold is due, these are written into one. One
        job writes all values of ``by``; it may be repeated after a failure at any point.
        """
        before = self.state(spark)
        state = before.state
        found = self._epochs(spark, state)
        newest: dict[str, int] = {}
        for _, stream, epoch, _ in found:
            newest[stream] = max(epoch, newest.get(stream, -1))
        last = {s: e if all_epochs else e - 1 for s, e in newest.items()}
        due = [(v, s, e, place) for v, s, e, place in found if e <= last[s]]
        if due:
            live = {v: list(own) for v, own in state.get("runs", {}).items()}
            touched = sorted({v for v, _, _, _ in due})
            merged = {v: live[v] for v in touched if live.get(v) and (self.fold or len(live[v]) >= runs)}
            run = before.sequence + 1
            for value in touched:  # what an attempt that failed has left
                storage.remove(spark, f"{self.closed}/{value}/run={run}")
            rows = self._rows(spark, self.open, [place for _, _, _, place in due])
            if merged:
                rows = rows.unionByName(self._rows(spark, self.closed, self._runs(merged)), allowMissingColumns=True)
            if self.fold:
                rows = self.fold(rows)
            rows = _sorted(rows.withColumn("run", F.lit(run)).hint("rebalance", self.by), self.by, *self.order)
            rows.write.mode("append").partitionBy(self.by, "run").parquet(self.closed)
            for value in touched:
                live[value] = [*([] if value in merged else live.get(value, [])), run]
            after = {"up_to": {**state.get("up_to", {}), **{s: e for s, e in last.items() if e >= 0}}, "runs": live}
            before = commits.commit(spark, self.log, before, after)
        self._sweep(spark, before.state)
        return len({(s, e) for _, s, e, _ in due})

    def _sweep(self, spark: SparkSession, state: dict) -> None:
        """Remove folders that the state has made superfluous."""
        up_to, live = state.get("up_to", {}), state.get("runs", {})
        for place in storage.matching(spark, self.open, f"{self.by}=*/stream=*/epoch=*"):
            values = storage.values_of(place)
            if int(values["epoch"]) <= up_to.get(values["stream"], -1):
                storage.remove(spark, f"{self.open}/{place}")
        for place in storage.matching(spark, self.closed, f"{self.by}=*/run=*"):
            value, run = place.split("/")
            if int(run.removeprefix("run=")) not in live.get(value, []):
                storage.remove(spark, f"{self.closed}/{place}")


def _sorted(df: DataFrame, *columns: str) -> DataFrame:
    """By the partition column first, which spares the writer a sort of its own."""
    return df.sortWithinPartitions(*columns)
