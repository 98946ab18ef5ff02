"""Bytes of strings that stand twice, by buckets of anchored suffixes and one hash for each string.

Every ``LENGTH``-byte string that starts at two places of the corpus (never across documents) is
removed wherever it stands, byte by byte, judged on the input.

* **Initial buckets.** A suffix's bucket is named by its first ``GRAM`` bytes. Names are 64-bit
  hashes built by doubling, the name of a string from the names of its halves, so all tasks name alike.
  Of all places only anchors are shuffled: the anchor of a ``LENGTH``-byte string is the place inside it whose
  gram has the smallest name. Equal strings have equal anchors, so a string that stands twice has its anchor in a
  bucket of two suffixes or more; buckets of one are finished and leave.
* **Comparison.** No bucket is refined and no order of suffixes is made: a suffix that remains brings along the bytes of the strings whose anchor it
  is. Inside a bucket each of these strings gets one 64-bit name, built by doubling from the names of its
  parts (8, 16, 32, 64, 128 bytes); strings that share a name count as equal, bytes are not compared. Those between
  the first and the last found of one anchor overlap, so two numbers an anchor say what is covered.
* **Repetitions inside a document.** Where the same surroundings come again in one document (periodic
  text) they are covered, and one of them goes on.
* **Large buckets.** In buckets of more than ``LARGE`` suffixes (a passage that a third of all documents
  share) the strings themselves are shuffled by name and counted with partial aggregation, so no
  task holds the bucket.

Documents with equal bytes are represented by one of them, and from ``LENGTH`` bytes on removed in
full. Null text is empty, rows that repeat a doc_id and text are copies of one another, documents
shorter than ``LENGTH`` keep everything. Texts of any length are read in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.common import joined, map_rows, mix, signed, utf8
from weatherloom.session import cut_lineage

LENGTH, GRAM = 200, 32
REACH = LENGTH - GRAM + 1  # grams inside a string
LARGE = 10_000
PIECE = 1 << 19
PLACE_BITS = np.uint64(21)


def grams8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number."""
    n = max(0, len(data) - 7)
    return np.ndarray(n, "<u8", data, strides=(1,)).astype(np.uint64) if n else np.empty(0, np.uint64)


def doubled(names: np.ndarray, length: int) -> np.ndarray:
    """Names of strings twice as long."""
    return joined(names[:-length], names[length:]) if len(names) > length else names[:0]


def _sliding(function: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``function`` over every ``width`` neighbours."""
    done, out = 1, values
    while 2 * done <= width:
        out = function(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return function(out[:-rest], out[rest:]) if rest else out


class Anchors(NamedTuple):
    """In order: place and name of each anchor, and the first and last string that has it."""

    place: np.ndarray
    name: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def part(self, start: int, stop: int, shift: int) -> Anchors:
        return Anchors(self.place[start:stop] + shift, self.name[start:stop], self.low[start:stop] + shift, self.high[start:stop] + shift)


def _anchors_of_piece(data: np.ndarray, starts: np.ndarray) -> Anchors:
    """The anchor of a string is its gram of the smallest name, the leftmost of equals."""
    names = grams8(data)
    for length in (8, 16):
        names = doubled(names, length)
    names = mix(names)
    placed = names >> PLACE_BITS << PLACE_BITS | np.arange(len(names), dtype=np.uint64)
    place = (_sliding(np.minimum, placed, REACH)[starts] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1 if len(first) else first
    return Anchors(place[first], names[place[first]], starts[first], starts[last])


NO_ANCHORS = Anchors(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))


def _anchors_of_long(one: bytes) -> Anchors:
    parts = []
    for start in range(0, len(one) - LENGTH + 1, PIECE):
        data = np.frombuffer(one[start : start + PIECE + LENGTH - 1], np.uint8)
        parts.append(_anchors_of_piece(data, np.arange(len(data) - LENGTH + 1)).part(0, len(data), start))
    place, name, low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
    place, first, group = np.unique(place, return_index=True, return_inverse=True)
    lowest, highest = low[first], high[first].copy()
    np.minimum.at(lowest, group, low)
    np.maximum.at(highest, group, high)
    return Anchors(place, name[first], lowest, highest)


def anchors(raw: list[bytes]) -> list[Anchors]:
    """The anchors of each document; short documents are read together."""
    out = [NO_ANCHORS] * len(raw)
    batch: list[int] = []

    def read() -> None:
        data = np.frombuffer(b"".join(raw[i] for i in batch), np.uint8)
        sizes = np.array([len(raw[i]) for i in batch])
        ends = np.cumsum(sizes)
        starts = np.flatnonzero(np.arange(len(data)) + LENGTH <= np.repeat(ends, sizes))
        found = _anchors_of_piece(data, starts)
        cuts = np.searchsorted(found.place, np.concatenate(([0], ends)))
        for k, i in enumerate(batch):
            out[i] = found.part(cuts[k], cuts[k + 1], sizes[k] - ends[k])
        batch.clear()

    total = 0
    for i, one in enumerate(raw):
        if len(one) > PIECE:
            out[i] = _anchors_of_long(one)
        elif len(one) >= LENGTH:
            batch.append(i)
            total += len(one)
            if total > PIECE:
                read()
                total = 0
    if batch:
        read()
    return out


def string_names(data: np.ndarray) -> np.ndarray:
    """Names of the strings of ``LENGTH`` bytes from each place on."""
    levels = {8: grams8(data)}
    for length in (8, 16, 32, 64):
        levels[2 * length] = doubled(levels[length], length)
    n = max(0, len(data) - LENGTH + 1)
    return joined(joined(levels[128][:n], levels[64][128 : 128 + n]), levels[8][192 : 192 + n])


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _again_inside(data: bytes, found: Anchors) -> tuple[list[int], list[tuple[int, int]]]:
    """Anchors whose surroundings stood earlier in the same document, and what is covered by that.

    Periodic text has such anchors by the thousand; one of each goes on.
    """
    order = np.argsort(found.name, kind="stable")
    same = found.name[order][1:] == found.name[order][:-1]
    several = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    seen: dict[bytes, tuple[int, int]] = {}
    again, spans = [], []
    for i in several.tolist():
        low, high = int(found.low[i]), int(found.high[i]) + LENGTH
        first = seen.setdefault(data[low:high], (low, high))
        if first != (low, high):
            again.append(i)
            spans += [first, (low, high)]
    return again, _united(spans)


FOUND = "gram long, row long, place long, low long, high long"


def _anchor_rows(columns: dict[str, list]) -> dict[str, list]:
    """Anchors (gram, row, place), and what a document's repetitions cover in it (row, low, high)."""
    raw = [utf8(t) for t in columns["text"]]
    out: dict[str, list] = {"gram": [], "row": [], "place": [], "low": [], "high": []}
    for row, data, found in zip(columns["row"], raw, anchors(raw), strict=True):
        again, spans = _again_inside(data, found)
        kept = np.delete(np.arange(len(found.place)), again)
        n, k = len(kept), len(spans)
        out["gram"] += signed(found.name[kept]).tolist() + [None] * k
        out["row"] += [row] * (n + k)
        out["place"] += found.place[kept].tolist() + [None] * k
        out["low"] += [None] * n + [low for low, _ in spans]
        out["high"] += [None] * n + [high for _, high in spans]
    return out


SURROUNDINGS = "gram long, row long, place long, low long, bytes binary, large boolean"


def _surroundings(columns: dict[str, list]) -> dict:
    """The bytes of all strings that have the anchors asked for.

    ``wanted`` holds the anchors' places; those in large buckets as -1 - place.
    """
    out: dict[str, list] = {name: [] for name in ("gram", "row", "place", "low", "bytes", "large")}
    raw = [utf8(t) for t in columns["text"]]
    for row, data, wanted, found in zip(columns["row"], raw, columns["wanted"], anchors(raw), strict=True):
        asked = np.array(wanted, np.int64)
        large = asked < 0
        at = np.searchsorted(found.place, np.where(large, -1 - asked, asked))
        out["gram"].append(signed(found.name[at]))
        out["row"].append(np.full(len(at), row, np.int64))
        out["place"].append(found.place[at])
        out["low"].append(found.low[at])
        out["bytes"].extend(data[a:b] for a, b in zip(found.low[at].tolist(), (found.high[at] + LENGTH).tolist(), strict=True))
        out["large"].extend(large.tolist())
    return out | {name: np.concatenate(out[name]) for name in ("gram", "row", "place", "low")}


def _names_around(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of all strings in some pieces, the piece of each and its start there."""
    sizes = np.array([len(p) for p in pieces])
    names = string_names(np.frombuffer(b"".join(pieces), np.uint8))
    counts = sizes - LENGTH + 1
    piece = np.repeat(np.arange(len(pieces)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return names[np.repeat(np.cumsum(sizes) - sizes, counts) + start], piece, start


COVERED = "row long, low long, high long"


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Refine whole buckets, which arrive sorted; about ``PIECE`` bytes at a time."""
    schema = pa.schema([("row", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])

    def refined(rows: list[tuple]) -> pa.RecordBatch:
        names, piece, start = _names_around([r[4] for r in rows])
        order = np.argsort(names, kind="stable")
        ordered = names[order]
        same = ordered[1:] == ordered[:-1]
        twice = np.zeros(len(names), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        piece, start = piece[twice], start[twice]
        first = np.flatnonzero(np.diff(piece, prepend=-1))
        last = np.append(first[1:], len(piece)) - 1 if len(first) else first
        hit = piece[first]
        base = np.array([r[3] for r in rows], np.int64)[hit]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.array([r[1] for r in rows], np.int64)[hit]),
                pa.array(base + start[first]),
                pa.array(base + start[last] + LENGTH),
            ],
            schema=schema,
        )

    held: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for row in zip(*columns, strict=True):
            if size > PIECE and row[0] != held[-1][0]:
                yield refined(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield refined(held)


def _string_rows(columns: dict[str, list]) -> dict[str, np.ndarray]:
    names, piece, start = _names_around(columns["bytes"])
    base = np.array(columns["low"], np.int64)
    return {
        "name": signed(names),
        "row": np.array(columns["row"], np.int64)[piece],
        "place": np.array(columns["place"], np.int64)[piece],
        "start": base[piece] + start,
    }


def covered(docs: DataFrame, large: int = LARGE) -> DataFrame:
    """docs (doc_id, text) with ``spans``, the byte ranges (low, high) to remove, maximal and in order; null if none."""
    given = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    read = cut_lineage(map_rows(given.filter("text is not null"), FOUND, _anchor_rows, ["row", "text"]))
    found = read.filter("gram is not null").select("gram", "row", "place")
    inside = read.filter("gram is null").select("row", "low", "high")
    texts = given.filter(f"octet_length(text) >= {LENGTH}").select("row", F.md5("text").alias("same"))
    copies = texts.groupBy("same").agg(F.min("row").alias("row"), F.count("*").alias("copies"))
    repeated = found.groupBy("gram").agg(F.count("*").alias("times")).filter("times > 1")
    wanted = (
        found.join(repeated, "gram")
        .select("row", F.when(F.col("times") > large, -1 - F.col("place")).otherwise(F.col("place")).alias("place"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("place")).alias("wanted"))
        .join(copies.select("row"), "row", "left_semi")
    )
    one_each = given.dropDuplicates(["row"])
    around = cut_lineage(map_rows(one_each.join(wanted, "row"), SURROUNDINGS, _surroundings, ["row", "text", "wanted"]))
    small = around.filter("not large").repartition("gram").sortWithinPartitions("gram").mapInArrow(_covered, COVERED)
    strings = map_rows(
        around.filter("large"), "name long, row long, place long, start long", _string_rows, ["row", "place", "low", "bytes"], 2048
    )
    twice = strings.groupBy("name").agg(F.count("*").alias("times")).filter("times > 1").select("name")
    big = strings.join(twice, "name", "left_semi").groupBy("row", "place")
    big = big.agg(F.min("start").alias("low"), (F.max("start") + LENGTH).alias("high")).drop("place")
    spans = small.unionByName(big).unionByName(inside).groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    several = texts.join(copies.filter("copies > 1").select("same"), "same", "left_semi").select("row").distinct()
    marks = spans.join(several.withColumn("all", F.lit(True)), "row", "full")
    return given.join(marks, "row", "left")


def _summary(columns: dict[str, list]) -> dict[str, list]:
    out: dict[str, list] = {n: [] for n in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
    for doc_id, text, spans, whole in zip(columns["doc_id"], columns["text"], columns["spans"], columns["all"], strict=True):
        data = utf8(text)
        gone = [(0, len(data))] if whole else _united([(s["low"], s["high"]) for s in spans or ()])
        digest, at = hashlib.sha256(), 0
        for low, high in gone:
            digest.update(data[at:low])
            at = high
        digest.update(data[at:])
        out["doc_id"].append(doc_id)
        out["n_bytes"].append(len(data))
        out["n_removed"].append(sum(high - low for low, high in gone))
        out["n_spans"].append(len(gone))
        out["kept_sha256"].append(digest.hexdigest())
    return out


def removed(docs: DataFrame, large: int = LARGE) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 of the bytes that stay."""
    marked = covered(docs, large)
    kind = marked.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_rows(marked, schema, _summary, ["doc_id", "text", "spans", "all"])
