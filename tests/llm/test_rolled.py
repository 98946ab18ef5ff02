"""The fingerprint: shifted unspaced texts, half-edited short ones, and the scheme itself."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from test_text import EDGES, frame, pair_hash, signed

from weatherloom.llm import fingerprints
from weatherloom.llm.common import documents


def xxhash_of(text):
    import xxhash

    return xxhash.xxh64(text.encode(), seed=42).intdigest()


def rolled(text):
    """Number of grams, and the kept ones as (place, hash)."""
    import xxhash

    units = []
    for m in re.finditer(r"[^ \t\n\x0b\f\r]+", text):
        run = m.group()
        units += [run] if len(run) <= 8 else [run[i : i + 8] for i in range(len(run) - 7)]
    g = [signed(xxhash.xxh64(u.encode(), seed=42).intdigest()) for u in units]
    g = [pair_hash(*g[i : i + 4]) for i in range(len(g) - 3)] if len(g) >= 4 else [pair_hash(*g)] if g else []
    v = [x >> 27 for x in g]
    return len(v), list(enumerate(v)) if len(v) <= 64 else minima(list(enumerate(v)))


def minima(kept):
    spans = [kept[i : i + 8] for i in range(max(1, len(kept) - 7))] if kept else []
    return list(dict.fromkeys(min(s, key=lambda p: (p[1], -p[0])) for s in spans))


def alike(a, b):
    (n, x), (m, y) = a, b
    x, y = (minima(x) if n <= 64 < m else x), (minima(y) if m <= 64 < n else y)
    x, y = {h for _, h in x}, {h for _, h in y}
    return len(x & y) / len(x | y) if x | y else 1.0


def test_rolled_fingerprints_of_given_and_odd_texts(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in documents(spark, sf_dir).limit(60).collect()]
    texts += [(1000 + 7 * i, t) for i, t in enumerate([*EDGES, *(" ".join(f"w{i}" for i in range(n)) for n in range(1, 75))])]
    got = {r.doc_id: r for r in fingerprints.edited(frame(spark, texts)).collect()}
    texts = sorted((i, t or "") for i, t in texts)
    for i, (key, text) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        half = len(text) // 2
        own, other, following = rolled(text), rolled(text[: len(text) - half] + after[:half]), rolled(after)
        r = got[key]
        for found, want in ((r.fingerprint, own), (r.edited_fingerprint, other)):
            assert found == " ".join(f"{p:X}:{h & (1 << 37) - 1:X}" for p, h in want[1])
        assert (r.near_edited, r.near_next) == (pytest.approx(alike(own, other)), pytest.approx(alike(own, following)))


def likenesses(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "x"), "b", "y")
    shared = F.size(F.expr(f"array_intersect({fingerprints.hashes_of('x.kept')}, {fingerprints.hashes_of('y.kept')})"))
    rows = df.select("i", fingerprints.likeness("x", "y").alias("l"), shared.alias("shared")).orderBy("i").collect()
    return [r.l for r in rows], [r.shared for r in rows]


def test_shifted_unspaced_texts_are_alike(spark):
    rng = random.Random(3)
    base = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(4000))
    found, _ = likenesses(spark, [(base, "前" * k + base) for k in range(1, 9)])
    assert min(found) > 0.95


def test_shared_passages_at_the_guarantee_share_a_gram(spark):
    rng = random.Random(4)

    def run(n):
        return "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(n))

    def words(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    pairs = []
    for _ in range(40):
        mine, theirs = run(18), words(11)
        pairs.append((run(rng.randint(0, 300)) + mine + run(rng.randint(0, 300)), run(rng.randint(0, 300)) + mine + run(rng.randint(0, 300))))
        pairs.append((f"{words(rng.randint(1, 99))} {theirs} {words(rng.randint(1, 99))}", f"{words(rng.randint(1, 99))} {theirs} {words(9)}"))
    assert min(likenesses(spark, pairs)[1]) > 0


def test_half_edited_short_texts_are_half_alike(spark):
    pairs = []
    for n in (12, 16, 24, 34):
        own = [f"a{n}x{i}" for i in range(n)]
        pairs.append((" ".join(own), " ".join(own[: n - n // 2] + [f"b{i}" for i in range(n // 2)])))
    found, _ = likenesses(spark, pairs)
    assert all(0.1 < l < 0.6 for l in found)
    long = [f"c{i}" for i in range(68)]  # 65 grams beside 64
    assert likenesses(spark, [(" ".join(long), " ".join(long[:67]))])[0][0] > 0.8


def test_the_two_cases_of_a_review(spark):
    rng = random.Random(8)
    base = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(2000))
    words = " ".join(f"w{i}" for i in range(30))
    rows = fingerprints.edited(frame(spark, [(1, base), (2, "前" + base), (3, words), (4, words + " more")])).collect()
    near = {r.doc_id: r.near_next for r in rows}
    assert near[1] > 0.99 and 0.5 < near[3] < 1.0


def test_rows_without_an_id_are_spread(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "PER_RANGE", 8)
    texts = [(None, f"text {i} " * 5) for i in range(200)] + [(i, f"own {i} " * 5) for i in range(50)] + [(None, "text 3 " * 5)]
    given = frame(spark, texts).select("doc_id", "text", F.xxhash64("text").alias("hash"))
    sizes = [r["count"] for r in given.withColumn("r", fingerprints._ranges(given)).groupBy("r").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 40
    order = sorted(((i is not None, i or 0, signed(xxhash_of(t))), t) for i, t in texts)
    want = []
    for k, (_, text) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(text) // 2
        want.append(hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest())
    assert sorted(r.edited_sha256 for r in fingerprints.edited(frame(spark, texts)).collect()) == sorted(want)
