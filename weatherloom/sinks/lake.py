"""The layers of the lake and how they are written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructType

from weatherloom import fixed_values as V
from weatherloom import schemas
from weatherloom.functions import times
from weatherloom.operators import filters, project
from weatherloom.sinks import commits, storage
from weatherloom.sources import files


@dataclass(frozen=True)
class Lake:
    """Paths below one root. Audit and control rows live outside the data layers."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/readings"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def exports(self) -> str:
        return f"{self.root}/exports"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"

    @property
    def bronze_commits(self) -> str:
        return f"{self.root}/control/bronze"

    @property
    def staging(self) -> str:
        return f"{self.root}/staging"

    def staging_of(self, run: str) -> str:
        """A folder of its own for each run, so that two runs do not read each other's."""
        return f"{self.staging}/{run}"

    def gold_table(self, name: str) -> str:
        return f"{self.gold}/{name}"


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return files.parquet_or_empty(spark, f"{path}/commits", schemas.COMMIT)


def _version(spark: SparkSession, path: str) -> int:
    return _commits(spark, path).agg(F.coalesce(F.max("version"), F.lit(0)).alias("version")).first()["version"]


def _slot(path: str, version: int) -> str:
    return f"{path}/slot={version % 2}"


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace the snapshot at ``path``; executors write their own files.

    Two slots take turns. The new version goes into the one not in use, and a
    commit row makes it the current one, so that a write that fails leaves the
    old version as it was. One writer at a time.
    """
    spark = df.sparkSession
    version = _version(spark, path) + 1
    df.write.mode("overwrite").parquet(_slot(path, version))
    row = spark.range(1).select(F.lit(version).cast("bigint").alias("version"))
    row.write.mode("append").parquet(f"{path}/commits")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The version committed last."""
    return spark.read.parquet(_slot(path, _version(spark, path)))


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result to the lake and read it back.

    Later passes then read only the columns they need, take row counts from
    file footers, and do not depend on shuffle files of lost executors.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


INITIAL = -1
PARTITIONS = StructType().add("ingest_source", StringType()).add("generation", IntegerType()).add("from_id", LongType()).add("ingest_date", DateType())


def last_mark(spark: SparkSession, lake: Lake, source: str) -> int:
    """How far ``source`` was read by its newest commit, 0 at first."""
    return commits.newest_of(spark, lake.bronze_commits, source).state.get("mark", 0)


def generation_of(lake: Lake, name: str, generation: int) -> str:
    """Each source has its own folder, and so has each first load of it with the increments that follow."""
    return f"{lake.bronze}/ingest_source={name}/generation={generation}"


def _write_batch(batch: DataFrame, path: str, *partitions: str) -> None:
    dated = batch.withColumn("ingest_date", F.to_date("ingestion_timestamp"))
    dated.write.mode("overwrite").partitionBy(*partitions, "ingest_date").parquet(path)


def _highest_id(source: DataFrame) -> int:
    return source.agg(F.coalesce(F.max("id"), F.lit(0)).alias("highest")).first()["highest"]


def _commit_batch(spark: SparkSession, lake: Lake, before: commits.Commit, generation: int, mark: int, batch: DataFrame) -> None:
    """One row says at once which generation counts, how far it goes and which columns it has."""
    same = before.state.get("generation", 0) == generation and "schema" in before.state
    known = StructType.fromJson(before.state["schema"]) if same else StructType()
    columns = schemas.union_of(known, batch.schema)
    commits.commit(spark, lake.bronze_commits, before, {"generation": generation, "mark": mark, "schema": columns.jsonValue()})


def append_increment(
    source: DataFrame, lake: Lake, name: str = "sensor_readings", at=None, up_to: int | None = None
) -> int:
    """Store the rows above the mark as one bronze batch; return how far the mark moved to.

    The batch covers ids above the old mark up to the highest id seen before
    reading, and its folder is named after the old mark. A run repeated after a
    failure therefore replaces its own half-written batch, and the mark moves
    only once the batch is complete. ``up_to`` gives the highest id where it is
    known already, as from a database's index.
    """
    spark = source.sparkSession
    at = times.moment(at)
    before = commits.newest_of(spark, lake.bronze_commits, name)
    mark, generation = before.state.get("mark", 0), before.state.get("generation", 0)
    highest = _highest_id(source) if up_to is None else up_to
    if highest <= mark:
        return mark
    rows = source.filter((F.col("id") > mark) & (F.col("id") <= highest))
    batch = rows.transform(project.canonical).transform(project.ingest_stamps, at)
    _write_batch(batch, f"{generation_of(lake, name, generation)}/from_id={mark}")
    _commit_batch(spark, lake, before, generation, highest, batch)
    return highest


def initial_load(
    source: DataFrame,
    lake: Lake,
    name: str = "sensor_readings",
    at=None,
    page_size: int = V.PAGE_SIZE,
    up_to: int | None = None,
) -> int:
    """Store the whole source in one parallel job, its pages numbered as batches.

    It begins a new generation, which replaces everything stored of this source
    before, first load and increments alike, with the one commit that also sets
    the mark. Until then readers and increments go by the old generation and
    its mark, so a load that fails changes nothing.
    """
    spark = source.sparkSession
    at = times.moment(at)
    highest = _highest_id(source) if up_to is None else up_to
    rows = source.filter(F.col("id") <= highest).transform(project.canonical)
    batch = rows.transform(project.initial_batch_ids, page_size).withColumn("ingestion_timestamp", at)
    before = commits.newest_of(spark, lake.bronze_commits, name)
    generation = before.state.get("generation", 0) + 1
    _write_batch(batch.withColumn("from_id", F.lit(INITIAL)), generation_of(lake, name, generation), "from_id")
    _commit_batch(spark, lake, before, generation, highest, batch)
    return highest


def _committed(spark: SparkSession, lake: Lake, after: dict[str, list[int]]) -> DataFrame | None:
    """Rows of committed batches with their partition columns; of a source in ``after`` only those that start at its mark there or later."""
    current = commits.newest(spark, lake.bronze_commits)
    columns, committed, paths = StructType(), F.lit(False), []
    for name, last in sorted(current.items()):
        start = after.get(name, [0, None])[1]
        if start is not None and start >= last.state["mark"]:
            continue
        columns = schemas.union_of(columns, StructType.fromJson(last.state["schema"]))
        below = F.col("from_id") < last.state["mark"]
        below = below | (F.col("from_id") == INITIAL) if start is None else below & (F.col("from_id") >= start)
        committed |= (F.col("ingest_source") == name) & below
        paths.append(generation_of(lake, name, last.state["generation"]))
    if not paths:
        return None
    reader = spark.read.schema(StructType([*columns.fields, *PARTITIONS.fields])).option("basePath", lake.bronze)
    return reader.parquet(*paths).filter(committed)


def read_bronze(spark: SparkSession, lake: Lake, with_date: bool = False) -> DataFrame:
    """All committed bronze batches with the columns of any; ``with_date`` keeps the partition date for pruning.

    The columns come from the commits, so no footer is read to plan a scan. Of a
    source's generation, batches that start below the mark are committed; one
    that is being written starts at it. Before the first batch there are no rows.
    """
    bronze = _committed(spark, lake, {})
    if bronze is None:
        bronze = spark.createDataFrame([], StructType([*schemas.BRONZE.fields, *PARTITIONS.fields]))
    bronze = bronze.drop("ingest_source", "generation", "from_id")
    return bronze if with_date else bronze.drop("ingest_date")


def batches_after(spark: SparkSession, lake: Lake, seen: dict[str, list[int]]) -> tuple[DataFrame | None, dict[str, list[int]], bool]:
    """The batches that came after ``seen`` (generation and mark of each source), what is seen now, and whether it begins anew.

    Where a source has another generation than ``seen`` says, all batches of all sources are given.
    Only folders of new batches are read.
    """
    current = commits.newest(spark, lake.bronze_commits)
    now = {name: [c.state["generation"], c.state["mark"]] for name, c in current.items()}
    anew = any(now.get(name, [None])[0] != generation for name, (generation, _) in seen.items())
    rows = _committed(spark, lake, {} if anew else seen)
    return None if rows is None else rows.drop(*PARTITIONS.names), now, anew


def release(spark: SparkSession, lake: Lake) -> list[str]:
    """Remove what no commit names: replaced and half-written generations and batches, and the staging of all runs.

    For a time when no job of this lake runs. Safe to repeat.
    """
    current = commits.newest(spark, lake.bronze_commits)
    gone = []
    for values, _ in list(storage.partitions(spark, lake.bronze)):
        last = current.get(values["ingest_source"])
        generation, start = int(values["generation"]), values.get("from_id")
        place = generation_of(lake, values["ingest_source"], generation)
        if last is None or generation != last.state["generation"]:
            gone += [place] * storage.remove(spark, place)
        elif start is not None and int(start) >= last.state["mark"]:
            place = f"{place}/from_id={start}"
            gone += [place] * storage.remove(spark, place)
    return gone + [lake.staging] * storage.remove(spark, lake.staging)


def drop_expired(spark: SparkSession, path: str, as_of: Column, days: int = V.RETENTION_DAYS, column: str = "ingest_date") -> list[str]:
    """Remove the partitions of days that :func:`filters.retained` leaves out; the folders that went.

    Partitions are removed by name, whole; no file is read or written again.
    Rows without a date stay. Safe to repeat.
    """
    first = str(spark.range(1).select(filters.first_retained(as_of, days).cast("string")).first()[0])
    return storage.remove_partitions(spark, path, column, lambda day: day[:1].isdigit() and day < first)
