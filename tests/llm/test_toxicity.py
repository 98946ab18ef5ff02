"""The toxicity network against a plain forward pass, numerical gradients and held-out rows."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weatherloom.llm import toxicity as T
from weatherloom.llm.common import documents
from weatherloom.llm.language import held_out

BAD = ("vilo", "grumm", "nastex")


def made(n, seed=1):
    rng = np.random.default_rng(seed)
    texts, toxic = [], []
    for i in range(n):
        words = [f"w{x}" for x in rng.integers(0, 80, rng.integers(5, 60))]
        if i % 3 == 0:
            words[int(rng.integers(0, len(words)))] = BAD[i % len(BAD) if i % 2 else 1] + str(rng.integers(0, 900))
        texts.append(" ".join(words))
        toxic.append(int(i % 3 == 0))
    return texts, toxic


@pytest.fixture(scope="module")
def weights():
    return T.fitted(*made(400), 1 / 3)


def plain(text, w):
    """The network written out over lists of words."""
    words = [x.lower() for x in re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.encode())]
    if not words:
        return float(w["share"])
    vectors = [sum(w["places"][p].astype(float) for p in T.places_of(x)) / 3 for x in words]
    pooled, block = [], 0
    for span in T.SPANS:
        rows = []
        for start in range(len(words)):
            total = np.zeros(T.FILTERS)
            for offset in range(span):
                if start + offset < len(words):
                    columns = slice((block + offset) * T.FILTERS, (block + offset + 1) * T.FILTERS)
                    total += vectors[start + offset] @ w["filters"][:, columns]
            rows.append(total)
        pooled += list(np.max(rows, axis=0))
        block += span
    top = np.maximum(np.array(pooled) + w["bias"], 0)
    return 1 / (1 + math.exp(-(float(top @ w["out"]) + float(w["out_bias"][0]))))


def test_forward_pass(weights):
    score = T.Scorer(weights)
    texts = [*made(30, 5)[0], "", "...", "one", "Vilo7", "é É x1", "a b"]
    assert np.allclose([score(t) for t in texts], [plain(t, weights) for t in texts], atol=1e-5)
    assert score(None) == score("") == pytest.approx(1 / 3)


def test_pieces_and_forgotten_words_make_no_difference(weights, monkeypatch):
    texts = [" ".join(made(40, 8)[0]), *made(20, 9)[0]]
    whole = [T.Scorer(weights)(t) for t in texts]
    monkeypatch.setattr(T, "PIECE", 20)
    monkeypatch.setattr(T, "KNOWN_WORDS", 5)
    small = T.Scorer(weights)
    assert np.allclose([small(t) for t in texts], whole, atol=1e-5)


def test_gradients(weights):
    w = {k: np.asarray(v, np.float64) for k, v in weights.items()}
    text = made(3, 4)[0][0]
    grads = {k: np.zeros_like(v) for k, v in w.items()}
    touched, moves = T.back(T._read(text), 1.0, 1.0, w, grads)
    np.add.at(grads["places"], touched, moves)

    def loss():
        return -math.log(plain(text, w))

    for name in ("out", "out_bias", "bias", "filters", "places"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        w[name][at] += 1e-4
        up = loss()
        w[name][at] -= 2e-4
        down = loss()
        w[name][at] += 1e-4
        assert (up - down) / 2e-4 == pytest.approx(grads[name][at], rel=0.05, abs=1e-5), name


def test_unseen_words_are_known_by_their_parts(weights):
    score = T.Scorer(weights)
    texts, toxic = made(120, 77)
    right = [(score(t) >= 0.5) == bool(y) for t, y in zip(texts, toxic, strict=True)]
    assert np.mean(right) > 0.9  # two thirds by guessing


def test_thresholds_by_language():
    scores = np.array([0.1] * 25 + [0.4] * 25 + [0.6] * 25 + [0.9] * 25 + [0.2])
    toxic = np.array([0] * 25 + [1] * 25 + [0] * 25 + [1] * 25 + [1])
    langs = ["low"] * 50 + ["high"] * 50 + ["rare"]
    cuts = T.calibrated(scores, toxic, langs, (0.5, 0.5))
    assert cuts == {None: 0.5, "low": pytest.approx(0.25), "high": pytest.approx(0.75)}
    # a rare label weighs little
    s, t = np.array([0.2] * 30 + [0.6] * 10 + [0.55] * 15 + [0.9] * 15), np.array([0] * 40 + [1] * 30)
    assert T.best_threshold(s, t, (0.99, 0.01)) == pytest.approx(0.75)
    assert T.best_threshold(s, t, (0.1, 0.9)) == 0.5


def test_the_shift_puts_the_threshold_at_one_half(weights):
    texts, toxic = made(200, 6)
    own = {**weights, "out_bias": weights["out_bias"] + 3}
    score = T.Scorer(own)
    moved = T.shifted(own, np.array([score(t) for t in texts]), np.array(toxic), (2 / 3, 1 / 3))
    score = T.Scorer(moved)
    assert np.mean([(score(t) >= 0.5) == bool(y) for t, y in zip(texts, toxic, strict=True)]) > 0.95


def test_edge_rows(spark, weights):
    schema = "doc_id long, text string, lang string, score string, toxic string"
    rows = [(1, None, "en", "a", "b"), (2, "", None, "a", "b"), (None, "vilo1 w2", "xx", "a", "b"), (3, "w1 " * 300_000, "en", "a", "b"), (3, "w1 " * 300_000, "en", "a", "b")]
    docs = spark.createDataFrame(rows, schema)
    got = T.flagged(T.scored(docs, weights), {None: 0.5, "xx": 0.0001}).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].score == by_id[2].score == pytest.approx(1 / 3)
    assert by_id[None].threshold == 0.0001 and by_id[None].flagged == 1 and by_id[2].threshold == 0.5
    assert T.scored(docs.limit(0), weights).count() == 0


def test_learning_needs_both_labels(spark):
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([(i, f"text {i}", "en") for i in range(40)], schema)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(i, 1) for i in range(40)] + [(None, 0), (1, None)], "doc_id long, toxic int")
    for labels, share in ((none, 0.0), (one, 1.0)):
        weights, cuts = T.learned(docs, labels)
        assert cuts == {None: 0.5} and {r.score for r in T.scored(docs, weights).collect()} == {share}
    weights, _ = T.learned(docs.limit(0), one)
    assert T.Scorer(weights)("x") == 1.0


def test_labels_of_held_out_rows_are_not_learned(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(T, "fitted", lambda texts, labels, share: seen.extend(texts) or {"share": share})
    docs = spark.createDataFrame([(i, f"text {i}", "en") for i in range(300)], "doc_id long, text string, lang string")
    T.learned(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")))
    ids = [int(t.split()[1]) for t in seen]
    assert len(ids) > 150 and all(zlib.crc32(str(i).encode()) % 5 for i in ids)


def test_held_out_rows(spark):
    big = "/root/testdata/sf0.1"
    docs, labels = documents(spark, big), spark.read.parquet(f"{big}/labels.parquet")
    weights, cuts = T.learned(docs, labels)
    own = T.flagged(T.scored(docs, weights), cuts).join(labels, "doc_id").filter(held_out())
    hit = ((F.col("score") >= T.THRESHOLD).cast("int") == F.col("toxic")).cast("int")
    n, right, by_lang = own.agg(F.count("*"), F.avg(hit), F.avg((F.col("flagged") == F.col("toxic")).cast("int"))).first()
    assert n > 700 and right > 0.96 and by_lang > 0.96


MANY = [f"{a}{b}" for a in ("vilo", "grum", "nast", "zork", "plif", "drax") for b in ("mek", "tun", "gor", "hib")]


def table(spark, n, seed=3):
    """Documents of which every third holds one of ``MANY`` words, in languages that differ."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = [f"w{x}" for x in rng.integers(0, 60, rng.integers(4, 12))]
        if i % 3 == 0:
            words[int(rng.integers(0, len(words)))] = MANY[int(rng.integers(0, len(MANY)))]
        rows.append((i, " ".join(words), "ab"[i % 2], int(i % 3 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")


def test_all_rows_are_learned_from(spark):
    docs = table(spark, 4000).repartition(4).cache()
    weights, cuts = T.learned(docs, docs, sample=8)
    score, fresh = T.Scorer(weights), table(spark, 300, 11).collect()
    assert np.mean([(score(r.text) >= 0.5) == bool(r.toxic) for r in fresh]) > 0.95  # 8 rows hold a third of the words at most
    assert set(cuts) == {None, "a", "b"}  # 20 calibrating rows of a label, more than 8 rows hold


def test_long_texts_are_learned_from(spark):
    docs = table(spark, 400).withColumn("text", F.expr("if(toxic = 1, concat(repeat('w1 w2 ', 300), text), text)"))
    weights, _ = T.learned(docs, docs, size=1000)  # toxic texts are larger, each alone
    score = T.Scorer(weights)
    assert len({score(r.text) for r in docs.limit(20).collect()}) > 1


def test_a_row_outside_the_sample_moves_the_network(spark):
    docs = table(spark, 300)
    one = docs.withColumn("text", F.when(F.col("doc_id") == 7, F.lit("quite another text")).otherwise(F.col("text")))
    start = T.fitted(*made(30), 1 / 3)
    rows = [T.labelled(d, d) for d in (docs, one)]
    assert all(r.filter("doc_id = 7").count() == 1 for r in rows)
    moved = [T.trained(r, start, shard=50) for r in (*rows, rows[0].repartition(5))]
    assert not np.array_equal(moved[0]["places"], moved[1]["places"])
    for k in start:  # and how the rows lie does not
        assert np.array_equal(moved[0][k], moved[2][k]), k


def test_moves_of_shards_are_averaged(spark):
    docs = table(spark, 200).withColumn("hash", F.xxhash64("text"))
    start = T.fitted(*made(30), 1 / 3)
    rate, order = T.LATER_RATE, F.xxhash64("doc_id", "toxic", "hash")
    rows = docs.withColumn("order", order).withColumn("shard", F.pmod("order", F.lit(4))).orderBy("order").collect()
    balance = (0.5 * 200 / 133, 0.5 * 200 / 67)
    after = [T.continued([(r.text, r.toxic) for r in rows if r.shard == s], start, balance, rate, [0, s]) for s in range(4)]
    moves = np.array([T._table(a).astype(float) - T._table(start) for a in after])
    n = np.maximum(1, (np.abs(moves).max(axis=2) > 1e-9).sum(axis=0))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(T, "ROUNDS", 1)
        got = T.trained(docs, start, shard=50)
    assert np.allclose(T._table(got), T._table(start) + moves.sum(axis=0) / n[:, None], atol=1e-5)


def test_training_by_pieces_makes_no_difference(weights, monkeypatch):
    monkeypatch.setattr(T, "DROPPED", 0)
    rows = list(zip([" ".join(made(12, 8)[0]), *made(40, 9)[0]], [1, *made(40, 9)[1]], strict=True))
    whole = T.continued(rows, weights, (1, 1), 0.1, 1)
    monkeypatch.setattr(T, "PIECE", 30)
    monkeypatch.setattr(T, "KNOWN_WORDS", 5)
    small = T.continued(rows, weights, (1, 1), 0.1, 1)
    assert all(np.allclose(whole[k], small[k], atol=1e-4) for k in whole)


def test_counts_stand_for_rows(spark, weights):
    rng = np.random.default_rng(2)
    scores, toxic, n = rng.integers(0, 40, 200) / 40, rng.integers(0, 2, 200), rng.integers(1, 9, 200)
    plainly = T.best_threshold(np.repeat(scores, n), np.repeat(toxic, n), (0.7, 0.3))
    assert T.best_threshold(scores, toxic, (0.7, 0.3), n) == plainly
    docs = table(spark, 500)
    found, score = T.counted(docs, weights).collect(), T.Scorer(weights)
    assert sum(r.n for r in found) == 500
    for cut in (0.25, 0.5, 0.75):
        wanted = sum(score(r.text) < cut for r in docs.filter("lang = 'a' and toxic = 1").collect())
        assert sum(r.n for r in found if r.lang == "a" and r.toxic == 1 and r.score < cut) == wanted
    cuts = T.language_thresholds(docs, weights, (2 / 3, 1 / 3))
    assert set(cuts) == {None, "a", "b"}
