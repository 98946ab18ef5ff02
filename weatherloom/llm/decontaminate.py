"""Documents that hold benchmark items, by SimHash of item-sized windows.

Words and five-word shingles are those of the n-gram join; an item with fewer
words is one shingle. A window of a document has as many shingles as an item. Its SimHash
has ``BITS`` bits: each shingle's hash votes on every bit, once for each time the
shingle occurs, so that repeated shingles weigh more. Sums of votes slide along
the text, so a window costs the same whatever its size.

A multi-index over blocks of eight bits finds all pairs of window and item
within ``RADIUS`` bits: of 16 blocks one differs in no more than a 16th of the radius
(``RADIUS // 16`` bits), so each item is filed in every block under all values that near. A
candidate is verified by the exact similarity of the weighted shingles: the sum
of the smaller counts over the sum of the larger ones must reach ``percent``. At
a similarity of 0.75 the expected distance is 22 bits with a deviation of 4.3, and the
radius lies four deviations above. Windows without any shingle of the
benchmark cannot reach a similarity above 0 and are not fingerprinted; windows at a
text's end may be shorter than the item, down to ``percent`` of its size.

Items come to the driver in blocks of ``BLOCK`` items, ordered by a hash, and
each block is sent out to one pass over the documents, so that what is sent has a
bound whatever the benchmark's size. Items and texts that are null or have no words match nothing.
Equal items are found under each of their ids; rows without an item_id are left out.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.common import map_rows, mix, shingle_stream

BITS, RADIUS, BLOCK_BITS = 128, 39, 8
BLOCK = 5_000
PIECE = 4096
PERCENT = 75


def votes(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of ``BITS`` bits, from two mixed forms of each hash."""
    both = np.stack([mix(hashes + np.uint64(1)), mix(hashes ^ np.uint64(0x5851F42D4C957F2D))], axis=1)
    return np.unpackbits(both.view(np.uint8), axis=1).astype(np.int32) * 2 - 1


def simhash(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as rows of bytes: a bit is set where the votes are positive."""
    return np.packbits(sums > 0, axis=1)


def _near_values(distance: int) -> np.ndarray:
    flips = [sum(1 << b for b in bits) for k in range(distance + 1) for bits in combinations(range(BLOCK_BITS), k)]
    return np.array(flips, np.uint8)


class Index:
    """A block of items: their weighted shingles, fingerprints and the multi-index."""

    def __init__(self, items: tuple[tuple[int, str], ...]) -> None:
        self.ids = [i for i, _ in items]
        hashes, _, counts = shingle_stream([t for _, t in items])
        self.parts = np.split(hashes, np.cumsum(counts)[:-1])
        self.sizes = np.array(counts)
        self.weights = [dict(zip(*(x.tolist() for x in np.unique(p, return_counts=True)), strict=True)) for p in self.parts]
        self.known = np.unique(hashes)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.known & np.uint64(len(self.maybe) - 1)] = True
        self.prints = np.concatenate([simhash(votes(p).sum(axis=0, keepdims=True)) for p in self.parts])
        near = _near_values(RADIUS // (BITS // BLOCK_BITS))
        # by size, filed[block, value, item]: the item's block is near the value
        self.of_size: dict[int, np.ndarray] = {}
        self.filed: dict[int, np.ndarray] = {}
        for size in np.unique(self.sizes).tolist():
            items = self.of_size[size] = np.flatnonzero(self.sizes == size)
            filed = np.zeros((BITS // BLOCK_BITS, 1 << BLOCK_BITS, len(items)), bool)
            for b in range(len(filed)):
                filed[b, near[:, None] ^ self.prints[items, b], np.arange(len(items))] = True
            self.filed[size] = filed
        # the sizes of the items that hold a known shingle
        self.held_by = np.zeros((len(self.known), len(self.filed)), bool)
        column = {size: i for i, size in enumerate(self.filed)}
        for part, size in zip(self.parts, self.sizes.tolist(), strict=True):
            self.held_by[np.searchsorted(self.known, part), column[size]] = True

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """The places of shingles that some item holds."""
        places = np.flatnonzero(self.maybe[hashes & np.uint64(len(self.maybe) - 1)])
        at = np.minimum(np.searchsorted(self.known, hashes[places]), len(self.known) - 1)
        return places[self.known[at] == hashes[places]]

    def within(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a window and an item of its size at most ``RADIUS`` bits apart."""
        filed = self.filed[size]
        near = np.zeros((len(prints), filed.shape[2]), bool)
        for b in range(len(filed)):
            near |= filed[b, prints[:, b]]
        window, item = np.nonzero(near)
        item = self.of_size[size][item]
        close = np.bitwise_count(prints[window] ^ self.prints[item]).sum(axis=1) <= RADIUS
        return window[close], item[close]

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Sum of smaller counts over sum of larger counts."""
        weights = self.weights[item]
        own, counts = np.unique(window, return_counts=True)
        common = sum(min(c, weights.get(h, 0)) for h, c in zip(own.tolist(), counts.tolist(), strict=True))
        return common / (len(window) + int(self.sizes[item]) - common)

    def search(self, hashes: np.ndarray, percent: int) -> dict[int, tuple[float, int]]:
        """Item -> best similarity and the first shingle of its window, for one document's shingles."""
        hits = self.hits(hashes)
        best: dict[int, tuple[float, int]] = {}
        if not len(hits):
            return best
        longest = int(self.sizes.max())
        for run in np.split(hits, np.flatnonzero(np.diff(hits) >= longest) + 1):
            first = int(run[0])
            while first <= run[-1]:  # a long run in pieces; a window belongs to the piece of the first hit it holds
                part = run[(run >= first) & (run < first + PIECE)]
                if len(part):
                    self._windows(hashes, part, percent, best)
                first += PIECE
        return best

    def _windows(self, hashes: np.ndarray, hits: np.ndarray, percent: int, best: dict) -> None:
        longest = int(self.sizes.max())
        low, high = max(0, int(hits[0]) - longest + 1), min(len(hashes), int(hits[-1]) + longest)
        sums = np.zeros((high - low + 1, BITS), np.int32)
        np.cumsum(votes(hashes[low:high]), axis=0, out=sums[1:])
        shared = self.held_by[np.searchsorted(self.known, hashes[hits])].any(axis=0)
        for size in np.array(list(self.filed))[shared].tolist():
            starts = np.arange(max(low, int(hits[0]) - size + 1), int(hits[-1]) + 1)
            starts = starts[starts + -(-size * percent // 100) <= len(hashes)]
            ends = np.minimum(starts + size, len(hashes))
            held = np.searchsorted(hits, ends) > np.searchsorted(hits, starts)
            starts, ends = starts[held], ends[held]
            if not len(starts):
                continue
            windows, items = self.within(simhash(sums[ends - low] - sums[starts - low]), size)
            for w, item in zip(windows.tolist(), items.tolist(), strict=True):
                start = int(starts[w])
                likeness = self.similarity(item, hashes[start : int(ends[w])])
                if 100 * likeness >= percent and likeness > best.get(item, (0.0, 0))[0]:
                    best[item] = (likeness, start)


@lru_cache(maxsize=1)
def _index(items: tuple[tuple[int, str], ...]) -> Index:
    return Index(items)


def _found(docs: DataFrame, items: tuple[tuple[int, str], ...], percent: int) -> DataFrame:
    def rows(columns: dict[str, list]) -> dict[str, list]:
        index = _index(items)
        hashes, _, counts = shingle_stream(columns["text"])
        out: dict[str, list] = {n: [] for n in ("doc_id", "item_id", "similarity", "word")}
        for doc_id, own in zip(columns["doc_id"], np.split(hashes, np.cumsum(counts)[:-1]), strict=True):
            for item, (likeness, start) in sorted(index.search(own, percent).items()):
                out["doc_id"].append(doc_id)
                out["item_id"].append(index.ids[item])
                out["similarity"].append(likeness)
                out["word"].append(start)
        return out

    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return map_rows(picked, f"doc_id {kind}, item_id long, similarity double, word long", rows, ["doc_id", "text"])


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, the best window's similarity and first word."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter(F.col("item_id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]")).distinct()
    blocks = -(-items.count() // block)
    found = []
    for i in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).orderBy("item_id", "text").collect()
        if part:
            found.append(_found(docs, tuple((r["item_id"], r["text"]) for r in part), percent))
    if not found:
        kind = docs.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, item_id long, similarity double, word long")
    return reduce(DataFrame.unionByName, found)


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, in which no item is found. Rows that share an id go together."""
    leaks = matches(docs, benchmark, percent).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["_leak"]), "left_anti")
