"""Folders of a table: listing and removing them through Hadoop's file systems, wherever the table lies."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _located(spark, path)
    return system.exists(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if there is no such path."""
    system, at = _located(spark, path)
    if not system.exists(at):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(at) if s.isDirectory())


def matching(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths below ``root``, relative to it, that match a glob; files and other folders are not looked at."""
    system, at = _located(spark, root)
    if not system.exists(at):
        return []
    above = system.makeQualified(at).toString().rstrip("/") + "/"
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = hadoop.FileUtil.stat2Paths(system.globStatus(hadoop.Path(f"{above}{pattern}")))
    return [p.toString().removeprefix(above) for p in found]


def values_of(path: str) -> dict[str, str]:
    """The values that the ``name=value`` folders of a path stand for."""
    return {n: unquote(v) for n, _, v in (part.partition("=") for part in path.split("/"))}


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder and what is in it; whether there was one. Removing it again does nothing."""
    system, at = _located(spark, path)
    return system.exists(at) and system.delete(at, True)


def partitions(spark: SparkSession, path: str) -> Iterator[tuple[dict[str, str], str]]:
    """The deepest ``name=value`` folders below ``path``: values by name, and the folder.

    One listing per folder above them; files are not looked at.
    """
    below = [f for f in folders(spark, path) if "=" in f]
    for folder in below:
        name, value = folder.split("=", 1)
        inner = list(partitions(spark, f"{path}/{folder}"))
        for values, place in inner or [({}, f"{path}/{folder}")]:
            yield {name: unquote(value), **values}, place


def remove_partitions(spark: SparkSession, path: str, column: str, expired) -> list[str]:  # noqa: ANN001
    """Remove the partition folders of ``column`` whose value ``expired`` accepts, however deep they lie; their paths.

    Safe to repeat: what a first run removed, a second one does not find.
    """
    gone = []
    for folder in folders(spark, path):
        if "=" not in folder:
            continue
        name, value = folder.split("=", 1)
        place = f"{path}/{folder}"
        if name != column:
            gone += remove_partitions(spark, place, column, expired)
        elif expired(unquote(value)) and remove(spark, place):
            gone.append(place)
    return gone
