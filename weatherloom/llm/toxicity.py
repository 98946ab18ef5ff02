"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

A text's words are its runs of ASCII letters and digits and of bytes above ASCII,
A-Z lower-cased. A word's vector is the mean of learned vectors in ``BUCKETS``
hashed places: one for the word, one for its first and one for its last
``AFFIX`` bytes, so that a word never seen is known by its parts. Filters of the
widths in ``SPANS`` run over the words of the whole text, each one's rectified
answer is max-pooled over all places, and a logistic unit makes one probability.

The network learns from every labelled row that is not held out, whole texts of any
length. Its weights start from a fit in one process, on at most ``SAMPLE`` rows and
``TRAIN_BYTES`` a label. Then come ``ROUNDS`` passes over all rows, which are dealt
out in shards of some ``SHARD`` rows: a task goes on from the common weights
through a shard, and the moves of the shards are averaged, each weight over the
shards that moved it. Only the network, whose size is fixed, comes to the driver.

A fifth of the rows, by a hash of the id, is kept from fitting for calibration. All
of them are scored and counted by label in ``GRID`` steps of the score: the step that
makes the fewest errors, labels weighed by their shares of all labelled rows, becomes
one half by a shift of the last bias; then a threshold is found for each language
from all of its calibrating rows. Errors at a step are exact counts.

A score depends on the text alone. ``flagged`` adds the decision at the threshold of
the row's language; null, and a language with too few calibrating rows, take
one half.

Empty and null texts, and those without a word, score the share of toxic rows
among the labelled ones (0 if there are none); without both labels to learn from
every score is that share. Repeated rows score alike, equal scores need no order,
an empty table gives no rows, and other columns of the documents, whatever their
names, are not looked at. Texts of any length are read whole, a piece at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import batched, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.common import labelled_texts, map_rows, utf8
from weatherloom.llm.language import held_out
from weatherloom.session import cut_lineage

SAMPLE = 2500
TRAIN_BYTES = 12 << 20
THRESHOLD = 0.5
BUCKETS, AFFIX, WIDTH = 1 << 15, 5, 12
SPANS, FILTERS = (1, 2, 3), 6
PIECE = 1 << 20
EPOCHS, BATCH, RATE, DECAY, DROPPED = 10, 16, 0.25, 1e-4, 0.3
KNOWN_WORDS = 1 << 16
LEAST_ROWS = 20
ROUNDS, SHARD, LATER_RATE = 3, 4096, 0.1
FINE = 1 << 30
GRID = 1 << 16
STEP = 128

Weights = dict[str, np.ndarray]
#: places of the different words of a piece, its words as rows of these, and whether it is the text's last
Part = tuple[np.ndarray, np.ndarray, bool]

_LOWER = bytes(32 if b < 128 and not chr(b).isalnum() else ord(chr(b).lower()) if b < 128 else b for b in range(256))


def pieces(data: bytes) -> Iterator[tuple[list[bytes], bool]]:
    """The words of a text, some ``PIECE`` bytes at a time, and whether they are the last.

    Each piece begins with the words that filters reaching over the last piece's end need.
    """
    data, start, before = data.translate(_LOWER), 0, []
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        words = before + data[start:end].split()
        yield words, end == len(data)
        before, start = words[len(words) - max(SPANS) + 1 :] if len(words) >= max(SPANS) else words, end


def places_of(word: bytes) -> tuple[int, int, int]:
    """The hashed places of a word and of its two ends."""
    parts = (word, b"^" + word[:AFFIX], b"$" + word[-AFFIX:])
    return tuple(zlib.crc32(p) % BUCKETS for p in parts)


def _blocks() -> list[tuple[int, int, slice]]:
    """Width, offset and columns of each filter block in ``filters``."""
    out, at = [], 0
    for span in SPANS:
        for offset in range(span):
            out.append((span, offset, slice(at, at + FILTERS)))
            at += FILTERS
    return out


BLOCKS = _blocks()
POOLED = len(SPANS) * FILTERS
#: filter and offset of each column in ``filters``
FILTER_OF = np.concatenate([np.arange(FILTERS) + SPANS.index(span) * FILTERS for span, _, _ in BLOCKS])
OFFSET_OF = np.repeat([offset for _, offset, _ in BLOCKS], FILTERS)


def answers(projected: np.ndarray, bias: np.ndarray, last: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Greatest answer of each filter over all places of words, given each word's share in every block, and where it is.

    A filter may reach over the end of a text, where words are zero, but not over that of an earlier piece.
    """
    n = len(projected)
    best, where = np.empty(POOLED, np.float32), np.empty(POOLED, np.int64)
    for i, span in enumerate(SPANS):
        total = np.zeros((n, FILTERS), np.float32)
        for s, offset, columns in BLOCKS:
            if s == span:
                total[: n - offset if offset < n else 0] += projected[offset:, columns]
        own = slice(i * FILTERS, (i + 1) * FILTERS)
        total = total if last else total[: max(0, n - span + 1)]
        if not len(total):
            best[own], where[own] = -np.inf, 0
            continue
        where[own] = total.argmax(axis=0)
        best[own] = total[where[own], np.arange(FILTERS)] + bias[own]
    return best, where


class Scorer:
    """Scores texts one after another, remembering what each filter answers to a word."""

    def __init__(self, weights: Weights) -> None:
        self.weights, self.rows = weights, {}
        self.table = np.empty((KNOWN_WORDS, FILTERS * sum(SPANS)), np.float32) if "out" in weights else None

    def _projected(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        if len(self.rows) + len(new) > KNOWN_WORDS:
            self.rows.clear()
            new = list(dict.fromkeys(words))
        if len(new) > len(self.table):  # a piece of very many short words
            self.table = np.empty((len(new), self.table.shape[1]), np.float32)
        if new:
            at = len(self.rows)
            places = np.array([places_of(w) for w in new])
            self.table[at : at + len(new)] = self.weights["places"][places].mean(axis=1) @ self.weights["filters"]
            self.rows.update(zip(new, range(at, at + len(new)), strict=True))
        return self.table[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))]

    def __call__(self, text: str | None) -> float:
        if "out" not in self.weights:
            return float(self.weights["share"])
        top = None
        for words, last in pieces(utf8(text)):
            if words:
                best = answers(self._projected(words), self.weights["bias"], last)[0]
                top = best if top is None else np.maximum(top, best)
        if top is None:
            return float(self.weights["share"])
        logit = float(np.maximum(top, 0) @ self.weights["out"] + self.weights["out_bias"][0])
        return 1 / (1 + np.exp(-min(30.0, max(-30.0, logit))))


def started(rng: np.random.Generator) -> Weights:
    return {
        "places": (rng.standard_normal((BUCKETS, WIDTH)) * 0.1).astype(np.float32),
        "filters": (rng.standard_normal((WIDTH, FILTERS * sum(SPANS))) / np.sqrt(WIDTH)).astype(np.float32),
        "bias": np.zeros(POOLED, np.float32),
        "out": (rng.standard_normal(POOLED) * 0.5).astype(np.float32),
        "out_bias": np.zeros(1, np.float32),
    }


def _squares(w: Weights) -> Weights:
    return {k: np.full(v.shape, 1e-2, np.float32) for k, v in w.items()}


def fitted(texts: list[str], labels: list[int], share: float, seed: int = 5) -> Weights:
    """Train by Adagrad on batches, both labels with half of the weight; only the words at which a filter answers most get a gradient.

    A share of ``DROPPED`` of the words is left out, others each time, so that a toxic word
    is learned beside other toxic words as well.
    """
    toxic = np.array(labels, np.float32)
    if not len(toxic) or toxic.min() == toxic.max():
        return {"share": np.float64(share)}
    rng = np.random.default_rng(seed)
    w = started(rng)
    squares = _squares(w)
    read = [_read(t) for t in texts]
    usable = np.array([i for i, r in enumerate(read) if len(r[0])])
    weight = np.where(toxic == 1, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean()))
    for epoch in range(EPOCHS):
        rng.shuffle(usable)
        rate = RATE * (1 - epoch / EPOCHS)
        for batch in np.array_split(usable, max(1, len(usable) // BATCH)):
            _learn([(thinned([(*read[i], True)], rng), toxic[i], np.float32(weight[i])) for i in batch], w, squares, rate)
    return w | {"share": np.float64(share)}


def thinned(parts: Iterable[Part], rng: np.random.Generator) -> Iterator[Part]:
    """The parts of a text without a share of ``DROPPED`` of their words."""
    for places, order, last in parts:
        kept = order[rng.random(len(order)) >= DROPPED]
        yield places, kept if len(kept) else order, last


def _learn(batch: list[tuple[Iterable[Part], np.float32, np.float32]], w: Weights, squares: Weights, rate: float) -> None:
    """One step of Adagrad by a batch of texts with their labels and weights."""
    grads = {k: np.zeros_like(v) for k, v in w.items() if k != "places"}
    touched, moves = [], []
    for parts, label, weight in batch:
        at, move = back_parts(parts, label, weight, w, grads)
        touched.append(at)
        moves.append(move)
    rows, home = np.unique(np.concatenate(touched), return_inverse=True)
    step = np.zeros((len(rows), WIDTH), np.float32)
    np.add.at(step, home, np.concatenate(moves))
    step = step / len(batch) + DECAY * w["places"][rows]
    squares["places"][rows] += step * step
    w["places"][rows] -= rate * step / np.sqrt(squares["places"][rows])
    for k, g in grads.items():
        g = g / len(batch) + (DECAY * w[k] if k in ("filters", "out") else 0)
        squares[k] += g * g
        w[k] -= rate * 0.2 * g / np.sqrt(squares[k])


def _placed(words: list[bytes], known: dict[bytes, tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the different words, and the words as rows of these; ``known`` remembers places."""
    different = list(dict.fromkeys(words))
    row = {w: i for i, w in enumerate(different)}
    if len(known) > KNOWN_WORDS:
        known.clear()
    for word in different:
        if word not in known:
            known[word] = places_of(word)
    places = np.array([known[w] for w in different], np.int32).reshape(-1, 3)
    return places, np.array([row[w] for w in words], np.int32)


def _read(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text's different words, and the words of the text as rows of these."""
    return _placed(utf8(text).translate(_LOWER).split(), {})


def winning(parts: Iterable[Part], w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Greatest answer of each filter over all parts of a text, and the places of the words from there on (-1 beyond the end)."""
    best = np.full(POOLED, -np.inf, np.float32)
    words = np.full((POOLED, max(SPANS), 3), -1, np.int64)
    for places, order, last in parts:
        first, middle, end = w["places"][places.T]
        vectors = (first + middle + end) / 3
        found, where = answers((vectors @ w["filters"])[order], w["bias"], last)
        better = found > best
        best[better] = found[better]
        at = where[:, None] + np.arange(max(SPANS))
        inside = better[:, None] & (at < len(order))
        words[better] = -1
        words[inside] = places[order[at[inside]]]
    return best, words


def back(read: tuple, label: np.float32, weight: np.float32, w: Weights, grads: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Add one text's gradients; returns those of the word vectors by place."""
    return back_parts([(*read, True)], label, weight, w, grads)


def back_parts(parts: Iterable[Part], label: np.float32, weight: np.float32, w: Weights, grads: Weights) -> tuple[np.ndarray, np.ndarray]:
    """``back`` of a text that is read a part at a time."""
    best, words = winning(parts, w)
    top = np.maximum(best, 0)
    logit = np.clip(top @ w["out"] + w["out_bias"][0], -30, 30)
    error = weight * np.float32(1 / (1 + np.exp(-logit)) - label)
    grads["out"] += error * top
    grads["out_bias"] += error
    g = error * w["out"] * (best > 0)
    grads["bias"] += g
    rows = words[FILTER_OF, OFFSET_OF]
    at = np.flatnonzero((rows[:, 0] >= 0) & (g[FILTER_OF] != 0))
    rows, own = rows[at], g[FILTER_OF[at]]
    grads["filters"][:, at] += w["places"][rows].mean(axis=1).T * own
    return rows.ravel(), np.repeat(own[:, None] * w["filters"][:, at].T / 3, 3, axis=0)


def continued(rows: Iterable[tuple[str, int]], weights: Weights, balance: tuple[float, float], rate: float, seed: int | list[int]) -> Weights:
    """The network after one pass over texts and labels; a batch of texts is held at a time, and a piece of one is read."""
    w = {k: v.copy() for k, v in weights.items() if k != "share"}
    squares, rng, known = _squares(w), np.random.default_rng(seed), {}

    def parts(text: str) -> Iterator[Part]:
        for words, last in pieces(utf8(text)):
            if words:
                yield *_placed(words, known), last

    for batch in batched(rows, BATCH):
        _learn([(thinned(parts(t), rng), np.float32(y), np.float32(balance[y])) for t, y in batch], w, squares, rate)
    return w


_DENSE = ("filters", "bias", "out", "out_bias")
_MOVES = [f"m{i}" for i in range(WIDTH)]


def _table(w: Weights) -> np.ndarray:
    """All weights as rows of ``WIDTH``: a row for each place, then the others."""
    rest = np.concatenate([w[k].ravel() for k in _DENSE])
    return np.concatenate([w["places"], np.pad(rest, (0, -len(rest) % WIDTH)).reshape(-1, WIDTH)])


def _untable(table: np.ndarray, like: Weights) -> Weights:
    out, rest, at = dict(like), table[BUCKETS:].ravel(), 0
    out["places"] = table[:BUCKETS].astype(np.float32)
    for k in _DENSE:
        out[k] = rest[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def trained(rows: DataFrame, weights: Weights, shard: int = SHARD) -> Weights:
    """The network after ``ROUNDS`` passes over all of (doc_id, toxic, hash, text), dealt out in shards of some ``shard`` rows.

    A shard's moves are integers of one ``FINE``-th, whose sums do not depend on their order.
    """
    usable = rows.filter(F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"))
    sizes = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return weights
    if "out" not in weights:  # the first rows had one label only
        weights = started(np.random.default_rng(5)) | weights
    total = sum(sizes.values())
    balance, shards = (0.5 * total / sizes[0], 0.5 * total / sizes[1]), -(-total // shard)
    order = F.xxhash64("doc_id", "toxic", "hash")
    dealt = usable.select(F.pmod(order, F.lit(shards)).cast("int").alias("shard"), order.alias("order"), "doc_id", "hash", "toxic", "text")
    dealt = dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "order", "doc_id", "toxic", "hash")
    dealt = cut_lineage(dealt.select("shard", "toxic", "text"))
    for turn in range(ROUNDS):
        given, rate = weights, LATER_RATE * (1 - turn / ROUNDS)

        def run(
            batches: Iterator[pa.RecordBatch], given: Weights = given, rate: float = rate, turn: int = turn
        ) -> Iterator[pa.RecordBatch]:
            parts = (b.slice(i, STEP).to_pylist() for b in batches for i in range(0, b.num_rows, STEP))
            before = _table(given)
            for own, group in groupby((r for part in parts for r in part), key=lambda r: r["shard"]):
                after = continued(((r["text"], r["toxic"]) for r in group), given, balance, rate, [turn, own])
                moves = np.rint((_table(after).astype(np.float64) - before) * FINE).astype(np.int64)
                at = np.flatnonzero(moves.any(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *map(pa.array, moves[at].T)], ["at", *_MOVES])

        moved = dealt.mapInArrow(run, ", ".join(["at int", *(f"{m} long" for m in _MOVES)]))
        found = moved.groupBy("at").agg(F.count("*").alias("n"), *(F.sum(m).alias(m) for m in _MOVES)).toArrow()
        sums = np.stack([found[m].to_numpy() for m in _MOVES], axis=1).astype(np.float64)
        table = _table(given).astype(np.float64)
        table[found["at"].to_numpy()] += sums / found["n"].to_numpy()[:, None] / FINE
        weights = _untable(table, given)
    return weights


def best_threshold(scores: np.ndarray, toxic: np.ndarray, shares: tuple[float, float], counts: np.ndarray | None = None) -> float:
    """The middle between two scores that makes the fewest errors, labels weighed by their shares; of several the nearest to one half.

    ``counts`` says how many rows have a score and label; one each without it.
    """
    counts = np.ones(len(scores), np.int64) if counts is None else counts
    values = np.unique(scores)
    cuts = np.concatenate([(values[1:] + values[:-1]) / 2, [THRESHOLD]])

    def below(label: int) -> np.ndarray:
        own = np.flatnonzero(toxic == label)
        own = own[np.argsort(scores[own], kind="stable")]
        sums = np.concatenate([[0], np.cumsum(counts[own])])
        return sums[np.searchsorted(scores[own], cuts)] / sums[-1]

    missed = shares[1] * below(1) + shares[0] * (1 - below(0))
    fewest = cuts[missed <= missed.min() + 1e-12]
    return float(fewest[np.abs(fewest - THRESHOLD).argmin()])


def _enough(toxic: np.ndarray, counts: np.ndarray | None = None) -> bool:
    counts = np.ones(len(toxic), np.int64) if counts is None else counts
    return min(counts[toxic == 0].sum(), counts[toxic == 1].sum()) >= LEAST_ROWS


def shifted(
    weights: Weights, scores: np.ndarray, toxic: np.ndarray, shares: tuple[float, float], counts: np.ndarray | None = None
) -> Weights:
    """The network with its last bias moved so that the best threshold over the calibrating rows lies at one half."""
    if "out" not in weights or not _enough(toxic, counts):
        return weights
    cut = min(0.99, max(0.01, best_threshold(scores, toxic, shares, counts)))
    return weights | {"out_bias": weights["out_bias"] - np.float32(np.log(cut / (1 - cut)))}


def calibrated(
    scores: np.ndarray, toxic: np.ndarray, langs: list[str | None], shares: tuple[float, float], counts: np.ndarray | None = None
) -> dict[str | None, float]:
    """A threshold for each language with ``LEAST_ROWS`` of both labels, and ``THRESHOLD`` for the rest under None."""
    out: dict[str | None, float] = {None: THRESHOLD}
    counts = np.ones(len(scores), np.int64) if counts is None else counts
    for lang in sorted({x for x in langs if x is not None}):
        own = np.array([x == lang for x in langs], bool)
        if _enough(toxic[own], counts[own]):
            out[lang] = best_threshold(scores[own], toxic[own], shares, counts[own])
    return out


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every different text labelled 0 or 1 that is not held out: doc_id, text, lang, hash, toxic, and whether it is ``apart`` for calibration."""
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(~held_out() & F.col("toxic").isin(0, 1))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    texts = texts.filter("text is not null").filter(~held_out()).withColumn("hash", F.xxhash64("text", "lang"))
    # labels grow with the texts, so they are not broadcast; copies of a row then lie together already
    rows = texts.join(marked.distinct().hint("merge"), "doc_id").dropDuplicates(["doc_id", "toxic", "hash"])
    apart = F.crc32(F.concat(F.lit("calibrate "), F.col("doc_id").cast("string"))) % 5 == 0
    return cut_lineage(rows.withColumn("apart", apart))


def counted(rows: DataFrame, weights: Weights) -> DataFrame:
    """How many rows of each lang and label score in each step of one ``GRID``-th: lang, toxic, score (the step's middle), n."""
    step = F.least(F.floor(F.col("score") * GRID), F.lit(GRID - 1))
    by_step = scored(rows, weights, ("toxic",)).groupBy("lang", "toxic", step.alias("step")).agg(F.count("*").alias("n"))
    return by_step.select("lang", "toxic", ((F.col("step") + 0.5) / GRID).alias("score"), "n")


def language_thresholds(rows: DataFrame, weights: Weights, shares: tuple[float, float]) -> dict[str | None, float]:
    """``calibrated`` over all rows, each language in a task; a language has at most two counts a step."""

    def own(counts: pa.Table) -> pa.Table:
        scores, toxic, n = (counts[c].to_numpy() for c in ("score", "toxic", "n"))
        lang = counts["lang"][0].as_py()
        cut = calibrated(scores, toxic, [lang] * len(scores), shares, n).get(lang)
        return pa.table({"lang": [lang], "threshold": pa.array([cut], pa.float64())})

    by_lang = counted(rows.filter("lang is not null"), weights).groupBy("lang").applyInArrow(own, "lang string, threshold double")
    found = by_lang.filter("threshold is not null").orderBy("lang").collect()
    return {None: THRESHOLD} | {r["lang"]: r["threshold"] for r in found}


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, size: int = TRAIN_BYTES) -> tuple[Weights, dict[str | None, float]]:
    """The network, and thresholds by language, from all labelled rows that are not held out.

    ``sample`` and ``size`` bound the rows and bytes a label that the weights start from.
    """
    every = labelled(docs, labels)
    rows, sizes = labelled_texts(every, labels, "toxic", held_out(), sample, size, ("lang",))
    total = sum(sizes.values())
    shares = (sizes.get(0, 0) / total, sizes.get(1, 0) / total) if total else (1.0, 0.0)
    own = [r for r in rows if zlib.crc32(f"calibrate {r['doc_id']}".encode()) % 5]
    weights = fitted([r["text"] for r in own], [r["toxic"] for r in own], shares[1])
    weights = trained(every.filter("not apart"), weights)
    if "out" not in weights:
        return weights, {None: THRESHOLD}
    other = every.filter("apart")
    counts = counted(other, weights).groupBy("toxic", "score").agg(F.sum("n").alias("n")).toArrow()
    scores, toxic, n = (counts[c].to_numpy() for c in ("score", "toxic", "n"))
    weights = shifted(weights, scores, toxic, shares, n)
    return weights, language_thresholds(other, weights, shares)


def scored(docs: DataFrame, weights: Weights, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang and score of every whole text, and the columns in ``also``."""
    score = Scorer(weights)  # each Python worker has its own copy

    def rows(columns: dict[str, list]) -> dict[str, list]:
        return columns | {"score": [score(t) for t in columns["text"]]}

    picked = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), *also)
    kinds = [f"{c} {picked.schema[c].dataType.simpleString()}" for c in ("doc_id", *also)]
    return map_rows(picked, ", ".join([*kinds, "lang string", "score double"]), rows, ["doc_id", "lang", "text", *also])


def flagged(scores: DataFrame, thresholds: dict[str | None, float]) -> DataFrame:
    """Scores with the threshold of each row's language and whether it is reached."""
    own = F.lit(thresholds[None])
    for lang, threshold in thresholds.items():
        if lang is not None:
            own = F.when(F.col("lang") == lang, threshold).otherwise(own)
    return scores.withColumn("threshold", own).withColumn("flagged", (F.col("score") >= F.col("threshold")).cast("int"))
