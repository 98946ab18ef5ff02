"""Describe a table: its columns and a small sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: standard SQL names of the simple types
SQL_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "timestamp_ntz": "TIMESTAMP",
}

REPORT = T.StructType(
    [
        T.StructField("ordinal_position", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("is_nullable", T.StringType()),
    ]
)


def columns(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability."""
    rows = [
        (
            position,
            field.name,
            SQL_NAMES.get(field.dataType.simpleString(), field.dataType.simpleString().upper()),
            "YES" if field.nullable else "NO",
        )
        for position, field in enumerate(df.schema.fields, 1)
    ]
    return df.sparkSession.createDataFrame(rows, REPORT)


def sample(df: DataFrame, order: str = "id", n: int = 3) -> DataFrame:
    """The first ``n`` rows by ``order``."""
    return df.orderBy(order).limit(n)


def columns_with_sample(df: DataFrame, order: str = "id", n: int = 3) -> DataFrame:
    """The column report with the sampled values of each column as one text.

    Only the ``n`` sampled rows are turned on their side.
    """
    cells = sample(df, order, n).select(
        F.col(order).alias("_order"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("cell"))
                    for c in df.columns
                ]
            )
        ),
    )
    texts = cells.groupBy("column_name").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_order", "cell"))), lambda x: x["cell"]), " | "
        ).alias("sample")
    )
    return columns(df).join(texts, "column_name", "left").select(*REPORT.fieldNames(), "sample")
