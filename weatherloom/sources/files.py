"""Reading Parquet trees."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOG_NAMES = ("log", "logs", "run_log", "execution_log")


def parquet_tree(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    merge_schema: bool | None = None,
    skip_unreadable: bool = False,
    name_glob: str | None = None,
) -> DataFrame:
    """Every Parquet file below ``path``.

    With a declared ``schema`` no footer is read to plan the scan, and columns
    an older file lacks are NULL. ``merge_schema`` finds the union of all files
    instead, at the price of reading every footer; it is the default where no
    schema is declared, so that no file's columns decide for the others.
    ``skip_unreadable`` leaves out files that are damaged or vanish while reading.
    """
    merge_schema = schema is None if merge_schema is None else merge_schema
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", merge_schema)
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def data_files_only(df: DataFrame, root: str, unwanted: tuple[str, ...] = LOG_NAMES) -> DataFrame:
    """Drop rows from files below a folder, or in a file, of an ``unwanted`` name.

    Whole names count, without their extension, and only below ``root``:
    neither ``biological`` nor a root called ``log`` is a log.
    """
    path = F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    below_root = F.element_at(F.split(path, re.escape(root.rstrip("/").split(":")[-1].lstrip("/")) + "/", 2), -1)
    names = F.transform(F.split(below_root, "/"), lambda name: F.split(name, r"\.")[0])
    return df.filter(~F.arrays_overlap(names, F.array(*[F.lit(name) for name in unwanted])))


def parquet_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The files below ``path``, or an empty frame of the same shape if there is no such path."""
    try:
        return parquet_tree(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
