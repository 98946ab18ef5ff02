"""What the operators share: reading, whole-text batches, hashing in numpy, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from weatherloom.session import cut_lineage

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_rows(df: DataFrame, schema: str, rows: Callable[[dict[str, list]], dict], columns: list[str], step: int = 128) -> DataFrame:
    """Map column lists to columns (lists or arrays), ``step`` rows at a time, through Arrow.

    A task holds one Arrow batch and the Python values of ``step`` rows.
    """
    wanted = df.select(*columns)
    target = to_arrow_schema(wanted.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                out = rows({name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)})
                arrays = [x if isinstance(x, pa.Array) else pa.array(x, f.type) for f in target for x in (out[f.name],)]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return wanted.mapInArrow(run, schema)


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrow lists of plain numbers."""
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*values, np.empty(0, kind.to_pandas_dtype())]), kind))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    out = values ^ (values >> _SHIFT)
    out *= _MULTIPLIER
    out ^= out >> _SHIFT
    out *= _MULTIPLIER
    out ^= out >> _SHIFT
    return out


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The name of two neighbours, from the names of each."""
    out = left * _ODD
    out += right
    out ^= out >> np.uint64(29)
    out *= _MULTIPLIER
    out ^= out >> _SHIFT
    return out


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


SHINGLE_WORDS = 5
BLOCK_BYTES = 1 << 19
_ROLL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)
_BASE = 0xD1342543DE82EF95
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BYTE[65:91] = _BYTE[97:123]
_powers: list[np.ndarray] = []


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < size:
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers.append(np.cumprod(factors, dtype=np.uint64))
    return _powers[0], _powers[1]


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _words_in(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of a block that ends with white space."""
    edges = np.diff(_IS_SPACE[block].view(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    powers, inverse = _power_tables(max(len(block), BLOCK_BYTES))
    sums = np.empty(len(block) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[block] * powers[: len(block)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), starts


def word_stream(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of some texts in order, the place of each in the joined bytes, and words per text.

    Words lie between ASCII white space and are lower-cased in A-Z alone.
    """
    raw = [utf8(text) for text in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    hashes, places, start = [], [], 0
    while start < len(data):
        end = min(start + BLOCK_BYTES, len(data))
        while end < len(data):  # on to the next white space
            step = np.flatnonzero(_IS_SPACE[data[end - 1 : end + BLOCK_BYTES]])
            if len(step):
                end += int(step[0])
                break
            end = min(end + BLOCK_BYTES, len(data))
        h, s = _words_in(data[start:end])
        hashes.append(h)
        places.append(s + start)
        start = end
    place = np.concatenate(places)
    ends = np.cumsum([len(r) + 1 for r in raw])
    return np.concatenate(hashes), place, np.diff(np.searchsorted(place, ends), prepend=0)


def shingle_stream(texts: list[str | None], size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all shingles of some texts in order, the index of each one's first word in its text, and shingles per text.

    A text with fewer words than a shingle has one shingle: all its words.
    """
    words, _, counts = word_stream(texts)
    total = np.zeros(len(words), np.uint64)
    for i in range(size):
        total[: max(0, len(words) - i)] += words[i:] * _ROLL[i]
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    index = np.arange(len(words)) - np.repeat(first, counts)
    left = np.repeat(counts, counts) - index
    short = np.repeat(counts < size, counts) & (index == 0)
    for at in np.flatnonzero(short).tolist():
        own = words[at : at + left[at]]
        total[at] = (own * _ROLL[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    kept = (left >= size) | short
    return mix(total[kept]), index[kept], np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))


def shingle_sets(texts: list[str | None], size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, _, counts = shingle_stream(texts, size)
    out = []
    for part in np.split(hashes, np.cumsum(counts)[:-1]):
        part.sort()
        out.append(part[np.concatenate(([True], part[1:] != part[:-1]))] if len(part) else part)
    return out


def sampled(df: DataFrame, group: str, size: int, groups: int, *order: str) -> tuple[DataFrame, dict]:
    """At most ``size`` rows of each group, those first by a hash of ``order``, with their ``rank``; and the groups' sizes.

    A hash filter leaves about four times as many as wanted before rows of a
    group meet, so a group of any size is ranked over a bounded number of rows.
    There may be at most ``groups`` groups; their sizes come to the driver.
    """
    spark = df.sparkSession
    sizes = {r[group]: r["n"] for r in df.groupBy(group).agg(F.count("*").alias("n")).limit(groups + 1).collect()}
    if len(sizes) > groups:
        raise ValueError(f"more than {groups} groups of {group}")
    kind = df.schema[group].dataType.simpleString()
    shares = spark.createDataFrame([(g, min(1.0, 4 * size / n)) for g, n in sizes.items()], f"_group {kind}, _share double")
    near = df.join(F.broadcast(shares), F.col(group) == F.col("_group"))
    near = near.filter(F.pmod(F.xxhash64(*order), F.lit(1 << 30)) < F.col("_share") * (1 << 30)).drop("_group", "_share")
    by_hash = Window.partitionBy(group).orderBy(F.xxhash64(*order, F.lit(1)), *order)
    return near.withColumn("rank", F.row_number().over(by_hash)).filter(F.col("rank") <= size), sizes


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, excluded: Column, sample: int, size: int, also: tuple[str, ...] = ()
) -> tuple[list[Row], dict[int, int]]:
    """Whole texts labelled 0 or 1, bounded by ``sample`` rows and ``size`` bytes a label; and the number of labelled rows of each.

    ``excluded`` says of a label's row whether it must not be learned from.
    Rows come in the order of a hash of the id, as many as the bytes hold. A row
    has doc_id, the label, text, and the text columns in ``also``.
    """
    spark = docs.sparkSession
    marked = labels.select("doc_id", F.col(label).cast("int").alias(label)).filter(~excluded & F.col(label).isin(0, 1))
    chosen, sizes = sampled(marked.distinct(), label, sample, 2, "doc_id")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), *[F.col(c).cast("string").alias(c) for c in also])
    texts = texts.filter("text is not null").withColumn("hash", F.xxhash64("text", *also)).withColumn("bytes", F.octet_length("text"))
    # at most 2 * sample rows, so they may be sent to where the texts are
    given = texts.join(F.broadcast(chosen), "doc_id").filter(F.col("bytes") <= size)
    found = given.select("doc_id", label, "hash", "bytes", "rank").distinct().orderBy("rank", "doc_id", label, "hash").limit(4 * sample)
    room, wanted = {0: size, 1: size}, []
    for row in found.collect():
        room[row[label]] -= row["bytes"]
        if room[row[label]] >= 0:
            wanted.append((row["doc_id"], row[label], row["hash"]))
        else:  # the label is full
            room[row[label]] = -1
    key = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {label} int, hash long"
    picked = texts.join(F.broadcast(spark.createDataFrame(wanted, key)), ["doc_id", "hash"])
    rows = picked.select("doc_id", label, "hash", "text", *also).dropDuplicates(["doc_id", label, "hash"]).collect()
    rows.sort(key=lambda r: (r["doc_id"], r[label], r["text"]))
    return rows, sizes


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, component) per linked node.

    The component is the smallest node. Alternating large and small stars: every
    round links each node's neighbours to the smallest one known, and needs a
    number of rounds that grows with the logarithm of the longest path. Links are
    written to the shared folder after each round; only a count and a checksum
    come to the driver.
    """
    edges = cut_lineage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def state(e: DataFrame) -> tuple:
        row = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(
            small.filter("u > v").unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        )
        after = state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
