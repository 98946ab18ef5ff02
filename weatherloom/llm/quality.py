"""Document quality by a small byte-level convolutional network in numpy.

A text is read whole, in chunks of ``CHUNK`` bytes that overlap. Each byte has a
learned vector of ``WIDTH`` numbers and one more channel that says whether the
four bytes there come again within the next ``LAG`` bytes (a filter of a few bytes
could not see that). Learned filters of ``SPAN`` bytes run over a chunk with a
step of ``STRIDE``; their rectified answers are averaged over segments, a second layer
combines them, its answers are max-pooled over all segments of all chunks, and a
logistic unit turns the pooled vector into one probability.

The network is fitted on a bounded sample of whole texts, read by the same chunks: per label
at most ``SAMPLE`` rows in the order of a hash of the id, and of these as many as
``TRAIN_BYTES`` hold together; a text that is larger alone is passed over. Only text
and label are used. Scores are given for whole texts of any length; empty and
null texts get the share of good documents in the sample. Without both labels
to learn from, every score is that share (0.5 if there is none). Repeated rows score alike, equal
scores need no order, and an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.common import map_rows, sampled, utf8
from weatherloom.llm.language import held_out

SAMPLE = 900
TRAIN_BYTES = 16 << 20
THRESHOLD = 0.3
CHUNK, OVERLAP = 4096, 64
WIDTH, SPAN, STRIDE, FILTERS, HIDDEN, SEGMENT = 6, 8, 4, 16, 12, 64
LAG = 28
CHANNELS = WIDTH + 1
EPOCHS, RATE = 8, 0.01
STEP = 128

Weights = dict[str, np.ndarray]


def repeats(data: np.ndarray) -> np.ndarray:
    """1 where the four bytes that start there start again within the next ``LAG`` places."""
    out = np.zeros(len(data), bool)
    if len(data) >= 4:
        grams = np.ndarray(len(data) - 3, "<u4", np.ascontiguousarray(data).data, strides=(1,))
        for lag in range(2, min(LAG + 1, len(grams))):
            out[: len(grams) - lag] |= grams[lag:] == grams[:-lag]
    return out


def segments_of(data: np.ndarray, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, filter answers and segment means of one chunk."""
    steps = SEGMENT // STRIDE
    n = -(-max(1, (len(data) - SPAN) // STRIDE + 1) // steps)
    room = (n * steps - 1) * STRIDE + SPAN
    padded = np.zeros((room, CHANNELS), np.float32)
    padded[: len(data), :WIDTH] = weights["bytes"][data[:room]]
    padded[: len(data), WIDTH] = repeats(data[:room])
    strides = padded.strides
    windows = np.lib.stride_tricks.as_strided(
        padded, (n * steps, SPAN * CHANNELS), (strides[0] * STRIDE, strides[1]), writeable=False
    )
    answers = np.maximum(windows @ weights["filters"] + weights["filter_bias"], 0)
    return windows, answers, answers.reshape(n, steps, FILTERS).mean(axis=1)


def chunks(data: np.ndarray) -> list[np.ndarray]:
    return [data[i : i + CHUNK] for i in range(0, max(1, len(data) - OVERLAP), CHUNK - OVERLAP)]


def pooled(data: np.ndarray, weights: Weights) -> np.ndarray:
    best = np.zeros(HIDDEN, np.float32)
    for chunk in chunks(data):
        means = segments_of(chunk, weights)[2]
        np.maximum(best, (means @ weights["hidden"] + weights["hidden_bias"]).max(axis=0), out=best)
    return best


def probability(text: str | None, weights: Weights) -> float:
    data = np.frombuffer(utf8(text), np.uint8)
    if not len(data) or "out" not in weights:
        return float(weights["share"])
    return float(1 / (1 + np.exp(-np.clip(pooled(data, weights) @ weights["out"] + weights["out_bias"][0], -30, 30))))


def fitted(texts: list[str], labels: list[int], seed: int = 7) -> Weights:
    """Train by Adam, one batch of texts at a time, with back-propagation written out."""
    good = np.array(labels, np.float32)
    share = np.float64(good.mean()) if len(good) else np.float64(0.5)
    if not len(good) or good.min() == good.max():
        return {"share": share}
    rng = np.random.default_rng(seed)

    def start(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(max(1, np.prod(shape[:-1])))).astype(np.float32)

    w: Weights = {
        "bytes": start(256, WIDTH) * 16,
        "filters": start(SPAN * CHANNELS, FILTERS) * 1.5,
        "filter_bias": np.zeros(FILTERS, np.float32),
        "hidden": start(FILTERS, HIDDEN) * 1.5,
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "out": start(HIDDEN) * 3,
        "out_bias": np.zeros(1, np.float32),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    data = [np.frombuffer(utf8(t), np.uint8) for t in texts]
    usable = np.array([i for i, d in enumerate(data) if len(d)])
    step = 0
    for epoch in range(EPOCHS):
        rng.shuffle(usable)
        for batch in np.array_split(usable, max(1, len(usable) // 16)):
            grads = {k: np.zeros_like(v) for k, v in w.items()}
            for i in batch:
                _back(data[i], good[i], w, grads)
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, (m, v) in moments.items():
                g = grads[k] / len(batch)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return w | {"share": share}


def _back(data: np.ndarray, label: np.float32, w: Weights, grads: Weights) -> None:
    """Add one text's gradients. Only the segments that win a maximum over all chunks get any."""
    units = np.arange(HIDDEN)
    best = np.full(HIDDEN, -np.inf, np.float32)
    home, winner = np.zeros(HIDDEN, np.int64), np.zeros(HIDDEN, np.int64)
    held: dict[int, tuple] = {}  # chunks that lead somewhere, at most HIDDEN
    for at, chunk in enumerate(chunks(data)):
        windows, answers, means = segments_of(chunk, w)
        scores = means @ w["hidden"] + w["hidden_bias"]
        segment = scores.argmax(axis=0)
        better = scores[segment, units] > best
        if better.any():
            best[better], winner[better], home[better] = scores[segment, units][better], segment[better], at
            held[at] = (chunk, windows, answers, means)
            held = {k: held[k] for k in np.unique(home).tolist()}
    top = np.maximum(best, 0)
    logit = np.clip(top @ w["out"] + w["out_bias"][0], -30, 30)
    error = np.float32(1 / (1 + np.exp(-logit)) - label)
    grads["out"] += error * top
    grads["out_bias"] += error
    g_top = error * w["out"] * (top > 0)
    grads["hidden_bias"] += g_top
    steps = SEGMENT // STRIDE
    for at, (chunk, windows, answers, means) in held.items():
        own = np.flatnonzero(home == at)
        grads["hidden"][:, own] += means[winner[own]].T * g_top[own]
        g_means = np.zeros_like(means)
        np.add.at(g_means, winner[own], g_top[own, None] * w["hidden"].T[own])
        hit = np.unique(winner[own])
        rows = (hit[:, None] * steps + np.arange(steps)).ravel()
        g = np.repeat(g_means[hit] / steps, steps, axis=0) * (answers[rows] > 0)
        grads["filter_bias"] += g.sum(axis=0)
        grads["filters"] += windows[rows].T @ g
        g_input = (g @ w["filters"].T).reshape(len(rows), SPAN, CHANNELS)[:, :, :WIDTH]
        places = rows[:, None] * STRIDE + np.arange(SPAN)
        inside = places < len(chunk)
        np.add.at(grads["bytes"], chunk[places[inside]], g_input[inside])


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, size: int = TRAIN_BYTES) -> Weights:
    """Fit on whole labelled texts that are not held out; at most ``sample`` rows and ``size`` bytes a label come to the driver."""
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(~held_out() & F.col("quality").isin(0, 1))
    chosen = sampled(marked.distinct(), "quality", sample, 2, "doc_id")[0]
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    texts = texts.withColumn("hash", F.xxhash64("text")).withColumn("bytes", F.octet_length("text"))
    # the sample's size is bounded, so it may be sent to where the texts are
    given = texts.join(F.broadcast(chosen), "doc_id").filter(F.col("bytes") <= size)
    sizes = given.select("doc_id", "quality", "hash", "bytes", "rank").distinct().orderBy("rank", "doc_id", "quality", "hash").limit(4 * sample)
    room, wanted = {0: size, 1: size}, []
    for row in sizes.collect():
        room[row["quality"]] -= row["bytes"]
        if room[row["quality"]] >= 0:
            wanted.append((row["doc_id"], row["quality"], row["hash"]))
        else:  # the label is full
            room[row["quality"]] = -1
    key = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, quality int, hash long"
    picked = texts.join(F.broadcast(docs.sparkSession.createDataFrame(wanted, key)), ["doc_id", "hash"])
    rows = picked.select("doc_id", "quality", "hash", "text").dropDuplicates(["doc_id", "quality", "hash"]).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], r["text"]))
    return fitted([r["text"] for r in rows], [r["quality"] for r in rows])


def scored(docs: DataFrame, weights: Weights) -> DataFrame:
    """doc_id and score of every whole text."""

    def rows(columns: dict[str, list]) -> dict[str, list]:
        return {"doc_id": columns["doc_id"], "score": [probability(t, weights) for t in columns["text"]]}

    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return map_rows(picked, f"doc_id {kind}, score double", rows, ["doc_id", "text"])


def accepted(docs: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that score the threshold or more."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        # some texts at a time become Python's; a batch of them whole would take several times its bytes
        parts = (texts.slice(i, STEP).to_pylist() for i in range(0, len(texts), STEP))
        return pa.array([probability(t, weights) for part in parts for t in part], pa.float64())

    return docs.filter(score(F.col("text").cast("string")) >= threshold)
