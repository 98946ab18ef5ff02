"""Continuously updated aggregates, alerts, window reports, duplicate removal.

Aggregates are kept as mergeable parts, one set for each micro-batch, in epoch
tables: a late reading counts like any other, a repeated micro-batch replaces its
parts, and a compaction folds the parts of many micro-batches into one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weatherloom import fixed_values as V
from weatherloom.operators import filters
from weatherloom.sinks import storage
from weatherloom.sinks.epochs import NO_VALUE, EpochTable
from weatherloom.streaming import run

REFRESH_SECONDS = 5
STREAM = "readings"
SHOWN = ("temperature", "humidity", "pressure", "pm25")


def alerts(readings: DataFrame, limit: float = V.HIGH_PM25) -> DataFrame:
    """Readings above the PM2.5 limit as they arrive."""
    return filters.pm25_alert(readings, limit)


# --- dashboard -----------------------------------------------------------------


def _sensor_parts(readings: DataFrame) -> DataFrame:
    """Mergeable parts of the panels: one row per sensor, made before rows are shuffled."""
    return readings.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("total"),
        *[
            f(c).alias(f"{c}_{name}")
            for c in SHOWN
            for name, f in (("n", F.count), ("sum", F.sum), ("min", F.min), ("max", F.max))
        ],
    )


def _merged() -> list[Column]:
    sums = [F.sum("total").alias("total"), *[F.sum(f"{c}_{n}").alias(f"{c}_{n}") for c in SHOWN for n in ("n", "sum")]]
    return sums + [f(f"{c}_{n}").alias(f"{c}_{n}") for c in SHOWN for n, f in (("min", F.min), ("max", F.max))]


def panels(path: str) -> EpochTable:
    """Parts of all panels; folded to one row per sensor."""
    return EpochTable(path, "panel", fold=lambda parts: parts.groupBy("panel", "sensor_id").agg(*_merged()))


def dashboard(readings: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the parts of all panels up to date, from one pass over each micro-batch.

    A refresh writes the rows of the sensors seen in it and rewrites nothing;
    :func:`panel` merges them.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        panels(path).write(_sensor_parts(batch).withColumn("panel", F.lit("sensors")), STREAM, epoch)

    return run.per_batch(readings, store, checkpoint, trigger or run.every(REFRESH_SECONDS))


def panel(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``totals``: total, gauge means, lowest and highest values as one row; ``sensors``: one row per sensor."""
    parts = panels(path).read(spark)
    if parts is None:
        raise ValueError(f"no panels at {path} yet")
    if name == "totals":
        one = parts.agg(*_merged())
        return one.select(
            "total",
            *[
                F.round(x, 1).alias(f"{c}_{n}")
                for c in SHOWN
                for n, x in (("avg", F.try_divide(f"{c}_sum", f"{c}_n")), ("min", F.col(f"{c}_min")), ("max", F.col(f"{c}_max")))
            ],
        )
    if name != "sensors":
        raise ValueError("panels are totals and sensors")
    rows = parts.groupBy("sensor_id").agg(*_merged())
    means = {V.SENSOR_MEAN_NAMES[c]: F.try_divide(f"{c}_sum", f"{c}_n") for c in V.SENSOR_MEAN_NAMES}
    return rows.select("sensor_id", "total", *[mean.alias(label) for label, mean in means.items()])


# --- windows -------------------------------------------------------------------

WINDOW_KEYS = ("window_start", "window_end", "sensor_id")


def _window_sums(parts: DataFrame, *keys: str) -> DataFrame:
    return parts.groupBy(*keys).agg(
        F.sum("readings").alias("readings"),
        F.sum("known").alias("known"),
        F.sum("sum").alias("sum"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )


def window_table(path: str) -> EpochTable:
    """Parts by the day of their window; folded to one row per window and sensor."""
    return EpochTable(path, "window_date", "date", fold=lambda parts: _window_sums(parts, "window_date", *WINDOW_KEYS))


def window_parts(readings: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, width: str = "10 minutes") -> StreamingQuery:
    """Keep mergeable sums per window of event time and sensor; late readings count like others.

    Readings without a time are summed in a window without start and end.
    Partial sums are formed before the shuffle, so a busy sensor costs each task one row per window.
    """
    spark = readings.sparkSession
    micros = spark.range(1).select(F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {width})")).first()[0]

    def store(batch: DataFrame, epoch: int) -> None:
        at = F.unix_micros(F.col("timestamp").cast("timestamp"))
        start = at - F.pmod(at, F.lit(micros))
        parts = batch.groupBy(F.timestamp_micros(start).alias("window_start"), "sensor_id").agg(
            F.count(F.lit(1)).alias("readings"),
            F.count("temperature").alias("known"),
            F.sum("temperature").alias("sum"),
            F.min("temperature").alias("min"),
            F.max("temperature").alias("max"),
        )
        end = F.timestamp_micros(F.unix_micros("window_start") + micros)
        dated = parts.withColumns({"window_end": end, "window_date": F.to_date("window_start")})
        window_table(path).write(dated, STREAM, epoch)

    return run.per_batch(readings, store, checkpoint, trigger)


def windows(spark: SparkSession, path: str) -> DataFrame:
    """The window report so far.

    Days that a compaction has folded and that no later micro-batch touched are
    read as they are; only the parts of other days are merged.
    """
    table = window_table(path)
    parts = table.read(spark)
    if parts is None:
        raise ValueError(f"no windows at {path} yet")
    touched = table.unsettled(spark)
    days = sorted(touched - {NO_VALUE})
    is_open = F.coalesce(F.col("window_date").cast("string").isin(days), F.lit(NO_VALUE in touched))
    columns = [*WINDOW_KEYS, "readings", "known", "sum", "min", "max"]
    rows = parts.filter(~is_open).select(*columns).unionByName(_window_sums(parts.filter(is_open), *WINDOW_KEYS))
    return rows.select(
        *WINDOW_KEYS,
        "readings",
        F.try_divide("sum", "known").alias("avg_temperature"),
        F.col("min").alias("min_temperature"),
        F.col("max").alias("max_temperature"),
    )


# --- distinct readings ---------------------------------------------------------

#: Folders of each day's readings, dealt by a hash of the key.
BUCKETS = 4
#: Up to so many folders a micro-batch names those it looks into; beyond that all are read.
LOOKED_INTO = 4096
NO_KEY = "none"


def distinct_table(path: str) -> EpochTable:
    return EpochTable(path, "slot", order=V.READING_KEY)


def _first_of_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest, compared by id first and then by the other columns; merged before the shuffle."""
    rest = sorted((c for c in df.columns if c not in keys), key=lambda c: c != "id")
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first")).select(*keys, "_first.*").select(*df.columns)


def store_distinct(readings: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Store the first reading of each key, however late its repeats come.

    Readings are kept by day and hash of their key, and a micro-batch looks only into
    the folders of its own keys, without what an earlier delivery of itself has
    stored. It is computed once and written to a folder of its own before it is
    compared. Readings without a sensor or a time have no key: they are all
    stored, and compared with nothing. ``buckets`` must not change for one ``path``.
    """
    keys = list(V.READING_KEY)
    keyed = F.lit(True)
    for k in keys:
        keyed &= F.col(k).isNotNull()
    day = F.date_format(F.col("timestamp").cast("timestamp"), "yyyyMMdd")
    # letters keep the folder's name a text
    slot = F.concat(F.lit("d"), day, F.lit(".b"), F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"))

    def store(batch: DataFrame, epoch: int) -> None:
        spark, table = batch.sparkSession, distinct_table(path)
        first = _first_of_each(batch.filter(keyed), keys).withColumn("slot", slot)
        rows = first.unionByName(batch.filter(~keyed).withColumn("slot", F.lit(NO_KEY)))
        arriving = f"{path}/_arriving"
        rows.write.mode("overwrite").parquet(arriving)
        rows = spark.read.schema(rows.schema).parquet(arriving)
        slots = {r["slot"] for r in rows.select("slot").distinct().limit(LOOKED_INTO + 1).collect()}
        known = table.read(spark, None if len(slots) > LOOKED_INTO else slots - {NO_KEY}, without=(STREAM, epoch))
        if known is not None:
            rows = rows.join(known.select("slot", *keys), ["slot", *keys], "left_anti")
        table.write(rows.hint("rebalance", "slot"), STREAM, epoch)  # a folder's rows in few files
        storage.remove(spark, arriving)

    return run.per_batch(readings, store, checkpoint, trigger)


def distinct_readings(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`store_distinct` has stored."""
    rows = distinct_table(path).read(spark)
    if rows is None:
        raise ValueError(f"no readings at {path} yet")
    return rows.drop("slot")
