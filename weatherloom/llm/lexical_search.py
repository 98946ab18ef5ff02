"""Ranked lexical search: item tiles times document tiles, as dense float64 products.

A term is a run of ASCII letters, digits and characters above ASCII, A-Z
lower-cased. Items are taken in blocks. A block's terms get compact numbers, one
pass over the documents writes each one's length and its counts of these terms,
and lengths and frequencies are summed over that table. A second pass multiplies: a
tile of documents (impacts, one row per document and one column per term) by
a tile of items (weights times occurrences). Impacts are below 10**6, and terms
are dealt to tiles so that no item's weights in a tile sum to more than 2**53
over that; every partial sum is therefore an exact integer in float64, and tiles
are added up in 64-bit integers. A term that an item repeats so often that it alone
would go beyond is split into several columns.

Every task keeps the best ``top`` documents of each item. A later document that
ties with the last one kept goes on if its id is smaller, so that ties end by
ascending id whatever the order of rows. The tasks' rows meet in two steps, so that no
group grows with the number of tasks alone.

Documents that are null, empty or without a term count for nothing and are not
found; items without a term find nothing. Rows are documents and items of their
own: a repeated document is found as often, a repeated item is answered as often.
Documents without an id come after those with one at equal scores. Very long
texts are split into words some ``PIECE`` bytes at a time. Empty tables give no rows, and other columns are not
looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from weatherloom.llm.common import lists, map_rows
from weatherloom.session import cut_lineage

TOP = 20
PIECE = 1 << 20
#: Bounds of one block of items: how many, and bytes of their texts (a longer item is a block alone).
BLOCK_ITEMS, BLOCK_BYTES = 1024, 8 << 20
#: Documents and terms of one tile.
TILE_DOCS, TILE_TERMS = 512, 4096
#: Fixed values of the score.
SCALED, HIGHEST_IMPACT = 1_000_000_000, 1_000_000
EXACT = 1 << 53
MERGE_GROUPS = 256

_TERM = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def term_counts(data: bytes | None) -> tuple[Counter, int]:
    """Occurrences of each term of a text in UTF-8, and how many there are in all."""
    counts: Counter = Counter()
    total, start = 0, 0
    data = (data or b"").translate(_TERM)
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        words = data[start:end].split()
        counts.update(words)
        total += len(words)
        start = end
    return counts, total


def blocks(benchmark: DataFrame) -> Iterator[tuple[list, list[Counter]]]:
    """Ids and term counts of items, one bounded block after another; a block's rows are drawn when it is their turn."""
    ids, counts, room = [], [], BLOCK_BYTES
    items = benchmark.select("item_id", F.col("text").cast("string").cast("binary").alias("text"))
    for row in items.toLocalIterator():
        size = len(row["text"] or b"")
        if ids and (size > room or len(ids) >= BLOCK_ITEMS):
            yield ids, counts
            ids, counts, room = [], [], BLOCK_BYTES
        ids.append(row["item_id"])
        counts.append(term_counts(row["text"])[0])
        room -= size
    if ids:
        yield ids, counts


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), and numbers and counts of the vocabulary's terms, for documents with any term."""

    def rows(columns: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": [], "n": []}
        terms, times = [], []
        for doc_id, data in zip(columns["doc_id"], columns["text"], strict=True):
            counts, n = term_counts(data)
            if not n:
                continue
            own = [(vocabulary[t], c) for t, c in counts.items() if t in vocabulary]
            out["doc_id"].append(doc_id)
            out["n"].append(n)
            terms.append(np.array([t for t, _ in own], np.int32))
            times.append(np.array([c for _, c in own], np.int64))
        return out | {"terms": lists(terms, pa.int32()), "times": lists(times, pa.int64())}

    texts = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return map_rows(texts, f"doc_id {kind}, n bigint, terms array<int>, times array<bigint>", rows, ["doc_id", "text"])


def weight(n_docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


class Tiles:
    """A block's items as tiles: the terms of each, and weights times occurrences as rows (term) and columns (item)."""

    def __init__(self, counts: list[Counter], vocabulary: dict[bytes, int], weights: dict[int, int]) -> None:
        self.items = len(counts)
        entries: dict[int, list[tuple[int, int]]] = {}
        for item, own in enumerate(counts):
            for term, times in own.items():
                number = vocabulary[term]
                if weights.get(number):
                    entries.setdefault(number, []).append((item, times * weights[number]))
        most = EXACT // HIGHEST_IMPACT
        self.tiles: list[tuple[np.ndarray, list[tuple[int, int, int]]]] = []
        terms, cells, load = [], [], np.zeros(self.items, object)

        def close() -> None:
            nonlocal terms, cells, load
            if terms:
                self.tiles.append((np.array(terms, np.int32), cells))
            terms, cells, load = [], [], np.zeros(self.items, object)

        for number in sorted(entries):
            left = entries[number]
            while left:  # more than once only if an item's weight is beyond what one column may hold
                part = [(item, min(w, most)) for item, w in left]
                if len(terms) == TILE_TERMS or any(load[item] + w > most for item, w in part):
                    close()
                for item, w in part:
                    load[item] += w
                    cells.append((len(terms), item, w))
                terms.append(number)
                left = [(item, w - most) for item, w in left if w > most]
        close()

    def dense(self, at: int) -> np.ndarray:
        terms, cells = self.tiles[at]
        out = np.zeros((len(terms), self.items))
        rows, columns, values = zip(*cells, strict=True)
        out[list(rows), list(columns)] = values
        return out


def impacts(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return SCALED * times // (1000 * times + 12 * m)


def tile_scores(tiles: Tiles, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, vocabulary: int, held: dict[int, np.ndarray]) -> np.ndarray:
    """Exact scores, one row per document and one column per item, from sparse impacts."""
    documents = len(starts) - 1
    row = np.repeat(np.arange(documents), np.diff(starts))
    scores = np.zeros((documents, tiles.items), np.int64)
    for at, (own, _) in enumerate(tiles.tiles):
        column = np.full(vocabulary, -1, np.int32)
        column[own] = np.arange(len(own))
        here = column[terms] >= 0
        if not here.any():
            continue
        dense = np.zeros((documents, len(own)))
        dense[row[here], column[terms[here]]] = values[here]
        matrix = held.get(at)
        if matrix is None:
            matrix = tiles.dense(at)
            if not held:  # the others are made again, as all of them have no bound
                held[at] = matrix
        scores += (dense @ matrix).astype(np.int64)
    return scores


class Best:
    """The best rows of each item so far, in a task."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.least = np.ones(items, np.int64)  # a score below this cannot go on
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some documents, one row each; ties with the last one kept are looked at by id."""
        for item in np.flatnonzero(scores.max(axis=0, initial=0) >= self.least):
            rows = np.flatnonzero(scores[:, item] >= self.least[item])
            own, who = scores[rows, item], ids[rows]
            if item in self.kept:
                own, who = np.concatenate([self.kept[item][0], own]), np.concatenate([self.kept[item][1], who])
            first = np.lexsort((who, -own))[: self.top]
            self.kept[item] = own[first], who[first]
            if len(first) == self.top:
                self.least[item] = own[first[-1]]


def best_of_tasks(table: DataFrame, tiles: Tiles, vocabulary: int, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """number (of the item), doc_id and score: the best of every task."""
    schema = "number int, doc_id bigint, score bigint"
    target = to_arrow_schema(table.sparkSession.createDataFrame([], schema).schema)
    last = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held = Best(tiles.items, top), {}
        for batch in batches:
            for start in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(start, TILE_DOCS)
                terms, times = part.column("terms"), part.column("times")
                sizes = np.diff(terms.offsets.to_numpy())
                lengths = part.column("n").to_numpy()
                # in Python's integers, as the product of a length and the number of documents may not fit 64 bits
                m = np.array([75 + 25 * int(n) * n_docs // n_terms for n in lengths], np.int64)
                flat = times.flatten().to_numpy()
                values = impacts(flat, np.repeat(m, sizes))
                starts = np.concatenate(([0], np.cumsum(sizes)))
                ids = part.column("doc_id").fill_null(last).to_numpy()
                best.add(tile_scores(tiles, starts, terms.flatten().to_numpy(), values, vocabulary, held), ids)
        for item, (scores, ids) in best.kept.items():
            who = pa.array(ids, pa.int64(), mask=ids == last)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item, np.int32)), who, pa.array(scores)], schema=target)

    found = table.filter(F.size("terms") > 0).select(F.col("doc_id").cast("bigint").alias("doc_id"), "n", "terms", "times")
    return found.mapInArrow(run, schema)


def ranked(rows: DataFrame, top: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _answered(docs: DataFrame, ids: list, counts: list[Counter], top: int, kind: str) -> DataFrame | None:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
    if not vocabulary:
        return None
    table = cut_lineage(counted(docs, vocabulary))
    n_docs, n_terms = table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # one row per term of the block
    frequent = table.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
    tiles = Tiles(counts, vocabulary, {r["t"]: weight(n_docs, r["count"]) for r in frequent})
    if not tiles.tiles:
        return None
    rows = best_of_tasks(table, tiles, len(vocabulary), n_docs, n_terms, top)
    grouped = rows.withColumn("_group", F.spark_partition_id() % MERGE_GROUPS)
    rows = ranked(ranked(grouped, top, "number", "_group").drop("rank"), top, "number")
    names = spark.createDataFrame(list(enumerate(ids)), f"number int, item_id {kind}")  # the items of one block
    return rows.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: each item's best documents.

    A block of items is answered and written before the next is drawn.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()
    parts = []
    for ids, counts in blocks(benchmark):
        answer = _answered(docs, ids, counts, top, kind)
        if answer is not None:
            parts.append(cut_lineage(answer))
    if not parts:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, parts)
