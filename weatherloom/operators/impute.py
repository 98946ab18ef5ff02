"""Imputation of missing values by a global or a per-sensor statistic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom.operators import groupstats
from weatherloom.session import cut_lineage

# measure number under which rows themselves are counted
ROWS = -1


def value_counts(df: DataFrame, columns, key: str | None = None) -> DataFrame:
    """How often each value of each column occurs, over all rows or per ``key``.

    Columns are numbered in ``measure``. With ``key`` there is also the number
    of rows, as measure :data:`ROWS`.
    """
    keys = [key] if key else []
    cells = [(i, F.col(c).cast("double")) for i, c in enumerate(columns)]
    if key:
        cells.append((ROWS, F.lit(0.0)))
    measured = df.select(
        *keys,
        F.inline(F.array(*[F.struct(F.lit(i).alias("measure"), v.alias("value")) for i, v in cells])),
    ).filter(F.col("value").isNotNull())
    return measured.groupBy(*keys, "measure", "value").agg(F.count(F.lit(1)).alias("n"))


def medians_of_counts(counts: DataFrame, columns, key: str | None = None) -> DataFrame:
    """Discrete median of each column from its value counts; with ``key`` also ``readings``.

    The counts are dealt out in ranges of their order and written with the
    number of their range. Sums per range tell in which one the middle lies;
    only its counts are put in order, so no task sorts more than one range.
    Groups without a key are left out.
    """
    group = [*([key] if key else []), "measure"]
    ranged = counts.repartitionByRange(*group, "value").withColumn("part", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    sums = ranged.groupBy(*group, "part").agg(F.sum("n").alias("in_part"))
    along = Window.partitionBy(*group).orderBy("part")
    middle = sums.select(
        *group,
        "part",
        (F.sum("in_part").over(along) - F.col("in_part")).alias("before"),
        F.sum("in_part").over(Window.partitionBy(*group)).alias("total"),
        "in_part",
    ).filter("2 * before < total AND 2 * (before + in_part) >= total")
    up_to = F.col("before") + F.sum("n").over(Window.partitionBy(*group, "part").orderBy("value"))
    ranked = ranged.join(middle, [*group, "part"]).select(*group, "value", "total", up_to.alias("up_to"))
    upper_half = ranked.filter("2 * up_to >= total")
    measure = F.col("measure")
    return upper_half.groupBy(*group[:-1]).agg(
        *([F.max(F.when(measure == ROWS, F.col("total"))).alias("readings")] if key else []),
        *[F.min(F.when(measure == i, F.col("value"))).alias(c) for i, c in enumerate(columns)],
    )


def medians(df: DataFrame, columns, key: str | None = None) -> DataFrame:
    """Discrete median of each column, over all rows or per ``key``: exact, and a value of the data.

    Equal values are counted first, inside each task and then across tasks.
    """
    return medians_of_counts(value_counts(df, columns, key), columns, key)


def _existing(df: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in df.columns]


def _filled(df: DataFrame, columns, *fills: str) -> DataFrame:
    """Fill each column from the struct columns ``fills``, in their order."""
    known = {c: F.coalesce(F.col(c).cast("double"), *[F.col(f)[c] for f in fills]) for c in columns}
    return df.withColumns(known).drop(*fills)


def mean_global(df: DataFrame, columns=V.MEAN_IMPUTED_COLUMNS, skip_zero: bool = False) -> DataFrame:
    """NULL becomes the column's mean. Filled columns are double.

    ``skip_zero`` leaves a column alone whose mean is exactly zero.
    """
    columns = _existing(df, columns)
    means = [F.nullif(F.avg(c), F.lit(0.0)) if skip_zero else F.avg(c) for c in columns]
    known = groupstats.with_global(df, "_mean", *[m.alias(c) for c, m in zip(columns, means)])
    return _filled(known, columns, "_mean")


def median_global(df: DataFrame, columns=V.MEDIAN_IMPUTED_COLUMNS) -> DataFrame:
    """NULL becomes the column's median."""
    columns = _existing(df, columns)
    overall = medians(df, columns).select(F.struct(*columns))
    return _filled(df.withColumn("_median", overall.scalar()), columns, "_median")


def median_per_sensor(
    df: DataFrame,
    columns=V.MEDIAN_IMPUTED_COLUMNS,
    key: str = "sensor_id",
    broadcast_keys: int = groupstats.BROADCAST_KEYS,
) -> DataFrame:
    """NULL becomes the sensor's median, or the global one where the sensor has none.

    The readings are counted once; both kinds of median come from the counts.
    """
    columns = _existing(df, columns)
    counts = cut_lineage(value_counts(df, columns, key))
    own = medians_of_counts(counts, columns, key).select(key, "readings", F.struct(*columns).alias("_own"))
    attached = groupstats.attach(df, own, key, broadcast_keys=broadcast_keys)
    everywhere = counts.filter(F.col("measure") != ROWS).groupBy("measure", "value").agg(F.sum("n").alias("n"))
    overall = medians_of_counts(everywhere, columns).select(F.struct(*columns))
    filled = _filled(attached.withColumn("_median", overall.scalar()), columns, "_own", "_median")
    return filled.select(*df.columns)


def unknown_location(df: DataFrame) -> DataFrame:
    return df.fillna({"location": V.UNKNOWN_LOCATION})
