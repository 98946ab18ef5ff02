"""The quality network is fitted on whole texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from weatherloom.llm import quality
from weatherloom.llm.common import documents
from weatherloom.llm.language import held_out

CALM = "calm words in a row here "
SCHEMA = "doc_id long, text string"


def late(n):
    """Texts with the same 10,000 first characters; the bad ones end otherwise."""
    texts = [f"{CALM * 400}{i} " + (CALM * 40 if i % 2 else "LOUD!! LOUDER!! WORDS!! " * 40) for i in range(n)]
    return texts, [i % 2 for i in range(n)]


def test_what_comes_late_is_learned(spark):
    texts, good = late(120)
    weights = quality.fitted(texts, good)
    assert all((quality.probability(t, weights) > 0.5) == g for t, g in zip(texts, good, strict=True))
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    labels = spark.createDataFrame(list(enumerate(good)), "doc_id long, quality int")
    weights = quality.learned(docs, labels)
    right = {r.doc_id: (r.score > 0.5) == good[r.doc_id] for r in quality.scored(docs, weights).collect()}
    assert all(right.values()) and len(right) == 120


def test_a_full_allowance_means_fewer_rows_not_shorter_ones(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fitted", lambda texts, labels: seen.extend(zip(texts, labels, strict=True)) or {})
    texts, good = late(40)
    texts += ["x" * 50_000]  # larger than the allowance alone
    docs = spark.createDataFrame([*enumerate(texts), (1, texts[1])], SCHEMA)
    labels = spark.createDataFrame(list(enumerate([*good, 1])), "doc_id long, quality int")
    quality.learned(docs, labels, size=45_000)
    assert sorted(g for _, g in seen) == [0] * 4 + [1] * 4 and all(t in texts for t, _ in seen)
    seen.clear()
    quality.learned(docs, labels)
    assert set(t for t, _ in seen) <= set(texts) and len(seen) > 25


def test_gradients_over_chunks():
    rng = np.random.default_rng(3)
    w = quality.fitted(["ab cd " * 30, "XY!! " * 30], [1, 0])
    w = {k: np.asarray(v, np.float64) for k, v in w.items()}
    data = rng.integers(32, 127, 3 * quality.CHUNK).astype(np.uint8)
    grads = {k: np.zeros_like(v) for k, v in w.items()}
    quality._back(data, np.float32(1), w, grads)

    def loss():
        return float(np.log1p(np.exp(-(quality.pooled(data, w) @ w["out"] + w["out_bias"][0]))))

    for name in ("out", "out_bias", "hidden", "hidden_bias", "filter_bias", "filters"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        w[name][at] += 1e-3
        up = loss()
        w[name][at] -= 2e-3
        down = loss()
        w[name][at] += 1e-3
        assert abs((up - down) / 2e-3 - grads[name][at]) < 0.05 * abs(grads[name][at]) + 1e-4, name


def test_held_out_long_documents(spark):
    big = "/root/testdata/sf0.1"
    docs, labels = documents(spark, big), spark.read.parquet(f"{big}/labels.parquet")
    long = docs.join(labels, "doc_id").filter(held_out() & (F.length("text") > 3000))
    scored = quality.scored(long, quality.learned(docs, labels)).join(labels, "doc_id")
    hit = ((F.col("score") >= quality.THRESHOLD).cast("int") == F.col("quality")).cast("int")
    n, right = scored.agg(F.count("*"), F.avg(hit)).first()
    assert n > 100 and right > 0.97
