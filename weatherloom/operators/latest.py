"""Newest rows, newest batches, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from weatherloom import fixed_values as V
from weatherloom.session import cut_lineage

ENTRY_KEYS = 100_000
IN_PARTITION = (1 << 33) - 1  # the bits of monotonically_increasing_id that count inside a partition


def newest_rows(df: DataFrame, n: int, column: str = "inserted_at", tie: str = "id") -> DataFrame:
    """The ``n`` newest rows of a few columns: each task keeps ``n``, nothing is sorted whole."""
    return df.orderBy(F.desc(column), F.desc(tie)).limit(n)


def newest_full_rows(df: DataFrame, n: int, column: str = "inserted_at", tie: str = "id") -> DataFrame:
    """The ``n`` newest rows with every column.

    A first pass reads the time column alone and finds the n-th newest instant.
    The wide pass then carries that instant into the file scan as a filter, so
    on a time-ordered table it opens only the newest row groups. Rows without
    a time come last. There are two scans, one of them of a single column.
    """
    times = df.select(column).orderBy(F.desc(column)).limit(n)
    bound = times.agg(F.min(column)).scalar()  # the lowest instant of all if fewer than n rows have a time
    return newest_rows(df.filter((F.col(column) >= bound) | F.col(column).isNull()), n, column, tie)


def newest_batches(
    df: DataFrame, n: int = V.LATEST_BATCHES, batch: str = "batch_id", at: str = "ingestion_timestamp"
) -> DataFrame:
    """Rows of the ``n`` batches that arrived last.

    Arrival time decides, so a first load does not outrank later increments.
    The list joined back has at most ``n`` rows. The earliest arrival among
    these batches goes along as a plain bound on ``at``: a table written batch
    by batch is then read from that batch on, not from its beginning.
    """
    recent = (
        df.groupBy(batch)
        .agg(F.max(at).alias("_last"), F.min(at).alias("_first"))
        .orderBy(F.desc("_last"), F.desc(batch))
        .limit(n)
    )
    since = recent.agg(F.min("_first")).scalar()
    return df.filter(F.col(at) >= since).join(F.broadcast(recent.select(batch)), batch, "left_semi")


def newest_snapshot(df: DataFrame, column: str = "generated_at") -> DataFrame:
    """Rows of the newest snapshot; on a partitioned table this prunes to its partition."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def page(df: DataFrame, offset: int, limit: int, column: str = "timestamp", tie: str = "id") -> DataFrame:
    """One page, newest first. Meant for small offsets: each task keeps ``offset + limit`` rows.

    :func:`indexed_page` serves deep ones.
    """
    return df.orderBy(F.desc(column), F.desc(tie)).offset(offset).limit(limit)


def page_index(df: DataFrame, column: str = "timestamp", tie: str = "id", keys: int = ENTRY_KEYS) -> DataFrame:
    """Counts per range of the order (time, id), newest first: what a deep page needs to know.

    One row for up to ``keys`` neighbouring keys: ``rows`` in the range, rows
    ``before`` it, and its newest and oldest key. The two key columns are dealt out
    by range once; equal keys meet there and stay in one entry, rows without a
    time come last. Sums run inside each range, and over ranges, never over all
    entries at once. The result is written to the shared folder and belongs to the version of the
    table it was made from.
    """
    order = [F.desc("at"), F.desc("key")]
    dealt = df.select(F.col(column).alias("at"), F.col(tie).alias("key")).repartitionByRange(*order)
    sorted_keys = dealt.groupBy("at", "key").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions(*order)
    placed = sorted_keys.withColumn("place", F.monotonically_increasing_id())
    part, inside = F.shiftrightunsigned("place", 33), F.col("place").bitwiseAND(F.lit(IN_PARTITION))
    pair = F.struct("at", "key")
    entries = placed.groupBy(part.alias("part"), F.call_function("div", inside, F.lit(keys)).alias("entry")).agg(
        F.sum("n").alias("rows"), F.max(pair).alias("newest"), F.min(pair).alias("oldest")
    )
    entries = cut_lineage(entries)
    parts = entries.groupBy("part").agg(F.sum("rows").alias("in_part"))
    parts = parts.withColumn("_before", F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part"))
    running = F.sum("rows").over(Window.partitionBy("part").orderBy("entry")) - F.col("rows")
    counted = entries.withColumn("_running", running).join(parts, "part")
    return cut_lineage(counted.select("rows", (F.col("_before") + F.col("_running")).alias("before"), "newest", "oldest"))


def indexed_page(
    df: DataFrame, index: DataFrame, offset: int, limit: int, column: str = "timestamp", tie: str = "id"
) -> DataFrame:
    """The page that :func:`page` gives, for any offset, from the few index entries it touches.

    Their oldest and newest time reach the file scan as bounds, and a task keeps no
    more rows than the first entry holds before the page, and the page. Beyond the last
    row the page is empty. Two times and the first entry's ``before`` come to the driver.
    """
    touched = index.filter((F.col("before") < offset + limit) & (F.col("before") + F.col("rows") > offset))
    ends = touched.agg(F.min("before").alias("before"), F.max("newest").alias("newest"), F.min("oldest").alias("oldest"))
    at, zoned = F.col(column), isinstance(df.schema[column].dataType, TimestampType)

    def spelled(end: str) -> Column:
        return (F.unix_micros(f"{end}.at") if zoned else F.col(f"{end}.at")).cast("string").alias(end)

    def bound(text: str) -> Column:
        return F.timestamp_micros(F.lit(int(text))) if zoned else F.lit(text).cast(df.schema[column].dataType)

    first = ends.select("before", spelled("newest"), spelled("oldest")).first()
    if first["before"] is None:
        return df.filter(F.lit(False))
    # plain bounds on the time are what the file scan can use
    if first["newest"] is None:
        bounds = at.isNull()
    elif first["oldest"] is None:
        bounds = (at <= bound(first["newest"])) | at.isNull()
    else:
        bounds = (at <= bound(first["newest"])) & (at >= bound(first["oldest"]))
    pair = F.struct(at.alias("at"), F.col(tie).alias("key"))
    exact = (pair <= ends.select("newest").scalar()) & (pair >= ends.select("oldest").scalar())
    return page(df.filter(bounds & exact), offset - first["before"], limit, column, tie)


def page_after(
    df: DataFrame,
    mark_time,
    mark_id=None,
    limit: int = V.POLL_LIMIT,
    column: str = "timestamp",
    tie: str = "id",
) -> DataFrame:
    """The oldest rows after a mark.

    With ``mark_id`` the mark is the pair (time, id), so rows sharing the
    boundary instant are not lost between two pages.
    """
    later = F.col(column) > mark_time
    if mark_id is not None:
        # the plain >= bound is what the file scan can use
        later = (F.col(column) >= mark_time) & (later | (F.col(tie) > mark_id))
    return df.filter(later).orderBy(column, tie).limit(limit)


def page_number(df: DataFrame, page_size: int = V.PAGE_SIZE, id_column: str = "id") -> Column:
    """The page each id falls into when the ids are cut into equal ranges from the lowest on.

    The page follows from the id itself: no row has to be ranked or sorted, and
    a retried task gives the same number. Gaps leave a page short, never overfull.
    """
    first = df.agg(F.min(id_column)).scalar()
    return F.call_function("div", F.col(id_column) - first, F.lit(page_size))


def id_pages(df: DataFrame, page_size: int = V.PAGE_SIZE, id_column: str = "id") -> DataFrame:
    """Number each row's page, as a ranged parallel read splits a table."""
    return df.withColumn("page", page_number(df, page_size, id_column))
