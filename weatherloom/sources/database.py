"""Reading a table of readings from a database over JDBC.

The drivers are the user's: any JDBC URL works whose driver is on the class
path. Increments are ordinary filters on the returned frame, which Spark pushes
into the database's WHERE clause. Spark does not push an order with a limit, nor a count beside a maximum, into
every database; polls, counts and extents are therefore sent as queries, in the dialect of
the URL, and only their few rows travel.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom import fixed_values as V
from weatherloom.operators import filters, latest, project

FETCH_SIZE = 10_000


def table(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """The whole table through one connection; filters and columns are pushed down."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, fetchsize=FETCH_SIZE, **options).load()


def _answer(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """The rows of a query that the database runs itself."""
    return spark.read.format("jdbc").options(url=url, query=query, fetchsize=FETCH_SIZE, **options).load()


def dialect_of(url: str) -> str:
    """The name after ``jdbc:``."""
    return url.split(":")[1].lower()


#: How a database says that only the first rows are wanted; before the columns or after the order.
_TOP = {"sqlserver": "TOP {n} ", "sybase": "TOP {n} "}
_FETCH = {"oracle": " FETCH FIRST {n} ROWS ONLY", "db2": " FETCH FIRST {n} ROWS ONLY", "derby": " FETCH FIRST {n} ROWS ONLY"}
_QUOTES = {"mysql": "``", "mariadb": "``", "sqlserver": "[]"}


def quoted(name: str, url: str) -> str:
    """A name, or names joined by dots, as the database quotes them; their own closing quotes are doubled."""
    left, right = _QUOTES.get(dialect_of(url), '""')
    return ".".join(left + part.replace(right, right * 2) + right for part in name.split("."))


def literal(value: datetime | int) -> str:
    """A number, or an instant as the standard writes it."""
    return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'" if isinstance(value, datetime) else str(int(value))


def count_and_max_query(url: str, name: str, id_column: str = "id") -> str:
    """Number of rows and highest id, 0 for an empty table, as one row."""
    return f"SELECT COUNT(*) AS total, COALESCE(MAX({quoted(id_column, url)}), 0) AS max_id FROM {quoted(name, url)}"


def count_and_max(spark: SparkSession, url: str, name: str, id_column: str = "id", **options: str) -> DataFrame:
    """:func:`count_and_max_id`, answered by the database: one row travels."""
    return _answer(spark, url, count_and_max_query(url, name, id_column), **options)


def poll_query(
    url: str,
    name: str,
    mark_time: datetime,
    mark_id: int | None = None,
    limit: int = V.POLL_LIMIT,
    column: str = "timestamp",
    id_column: str = "id",
) -> str:
    """The oldest ``limit`` rows after a mark, as :func:`latest.page_after` gives them, in the database's own words.

    The plain bound on the time comes first, so that an index on it serves.
    """
    at, tie, dialect = quoted(column, url), quoted(id_column, url), dialect_of(url)
    if mark_id is None:
        later = f"{at} > {literal(mark_time)}"
    else:
        later = f"{at} >= {literal(mark_time)} AND ({at} > {literal(mark_time)} OR {tie} > {literal(mark_id)})"
    first = _TOP.get(dialect, "").format(n=int(limit))
    last = "" if first else _FETCH.get(dialect, " LIMIT {n}").format(n=int(limit))
    return f"SELECT {first}* FROM {quoted(name, url)} WHERE {later} ORDER BY {at}, {tie}{last}"


def poll(spark: SparkSession, url: str, name: str, mark_time: datetime, mark_id: int | None = None, limit: int = V.POLL_LIMIT, **options: str) -> DataFrame:
    """The next rows after a mark; at most ``limit`` of them leave the database."""
    return _answer(spark, url, poll_query(url, name, mark_time, mark_id, limit), **options)


def count_and_max_id(df: DataFrame, id_column: str = "id") -> DataFrame:
    """Number of rows and highest id, 0 for an empty table."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.max(id_column), F.lit(0)).alias("max_id"),
    )


def range_options(
    first_id: int, last_id: int, page_size: int, most: int, id_column: str = "id"
) -> dict[str, str]:
    """Options that split a read into disjoint id ranges.

    One partition per page, up to ``most``: a partition is a task, and how many run at a time is
    the cluster's cores, which is what limits open connections. Unlike offset
    paging, rows that arrive meanwhile move nothing.
    """
    pages = max(1, -(-(last_id - first_id + 1) // page_size))
    return {
        "partitionColumn": id_column,
        "lowerBound": str(first_id),
        "upperBound": str(last_id + 1),
        "numPartitions": str(min(pages, most)),
    }


def id_extent_query(url: str, name: str, after_id: int, id_column: str = "id") -> str:
    key = quoted(id_column, url)
    return f"SELECT MIN({key}) AS first_id, MAX({key}) AS last_id FROM {quoted(name, url)} WHERE {key} > {literal(after_id)}"


def id_extent(
    spark: SparkSession, url: str, name: str, after_id: int = 0, id_column: str = "id", **options: str
) -> tuple[int, int]:
    """Lowest and highest id above ``after_id``; both ``after_id`` if there is none.

    The database answers from its index; no rows travel.
    """
    ends = _answer(spark, url, id_extent_query(url, name, after_id, id_column), **options).first()
    return (after_id, after_id) if ends[0] is None else (ends[0], ends[1])


def paged_table(
    spark: SparkSession,
    url: str,
    name: str,
    after_id: int = 0,
    page_size: int = V.PAGE_SIZE,
    most: int = 10_000,
    id_column: str = "id",
    **options: str,
) -> tuple[DataFrame, int]:
    """Rows above ``after_id``, read as disjoint id ranges in parallel, and their highest id.

    The ids present when the read begins fix its extent, for a first load
    (``after_id`` 0) as for an increment.
    """
    first_id, last_id = id_extent(spark, url, name, after_id, id_column, **options)
    ranges = range_options(first_id, last_id, page_size, most, id_column)
    rows = table(spark, url, name, **ranges, **options)
    return filters.id_after(rows, after_id, id_column, up_to=last_id), last_id


def new_readings(source: DataFrame, last_id: int = 0, up_to=None) -> DataFrame:
    """Canonical readings with an id above the mark."""
    return filters.id_after(source, last_id, up_to=up_to).transform(project.canonical)


def new_readings_by_time(source: DataFrame, mark_time, mark_id=None) -> DataFrame:
    """The next poll after a time mark, oldest first."""
    return latest.page_after(source, mark_time, mark_id)
