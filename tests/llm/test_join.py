"""Near duplicates and repeated bytes and lines against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weatherloom.llm import line_dedup, ngram_join, suffix_dedup
from weatherloom.llm.common import components, documents, shingle_sets, word_stream
from weatherloom.llm.ngram_join import common_count, levels, sketch_keys

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, extra=""):
    rows = [(i, t, None, "s", None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


def true_components(texts, percent=75):
    sets = {}
    for i, t in texts:
        w = words(t)
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            held[g].append(i)
    common = Counter((a, b) for own in held.values() for a in own for b in own if a < b)
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_word_stream_equals_split():
    texts = ["A  b\tc\x0bd\n", None, "", " \r\f ", "Éa É x  y", "one", "x" * 700_000 + " tail"]
    hashes, places, counts = word_stream(texts)
    assert counts.tolist() == [len(words(t)) for t in texts]
    flat = [w for t in texts for w in words(t)]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))
    assert (places[1:] > places[:-1]).all()


def test_sketches_differ_in_no_more_words_than_the_sets():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 7, 48, 300, 2000):
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        other = np.unique(np.concatenate([base[: n - n // 8], rng.integers(0, 1 << 63, n // 8, dtype=np.uint64)]))
        shared = set(levels(len(base))) & set(levels(len(other)))
        union = len(base) + len(other) - common_count(base, other)
        if 100 * common_count(base, other) >= 75 * union:
            assert any(set(sketch_keys(base, x).tolist()) & set(sketch_keys(other, x).tolist()) for x in shared)


def test_near_duplicates_of_the_given_documents(spark, sf_dir):
    docs = documents(spark, sf_dir)
    want = true_components([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(want)


def test_chains_copies_edges_and_hot_passages(spark):
    passage = " ".join(f"shared{i}" for i in range(60))
    texts = [(i, f"{passage} " + " ".join(f"own{i}x{j}" for j in range(150))) for i in range(120)]  # one passage in all
    texts += [(200 + i, "the same text for every copy of it here") for i in range(90)]
    base = [f"w{j}" for j in range(120)]
    texts += [(400 + i, " ".join(base[:i] + [f"new{i}"] + base[i + 1 :])) for i in range(0, 120, 3)]
    texts += [(600 + i, " ".join(f"c{j}" for j in range(6 * i, 6 * i + 70))) for i in range(20)]  # a chain of overlaps
    texts += [(800, None), (801, ""), (802, " \n\t "), (803, "One two"), (804, "oNE  two"), (805, "word"), (806, "z " * 5000)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(frame(spark, texts)).collect()}
    assert got == true_components(texts)


def test_repeated_ids_and_missing_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = frame(spark, [(5, a), (5, b), (3, a), (9, b), (None, a), (5, a)])
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(5, 3), (5, 3), (5, 3), (3, 3), (9, 3), (None, None)], key=repr)
    kept = ngram_join.one_of_each(docs.withColumn("component_id", F.lit("x")).withColumn("rep", F.lit(1)))
    assert sorted(kept.select("doc_id").toPandas()["doc_id"].fillna(-1)) == [-1, 3]
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_long_paths(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.sql("select 900L, 800L"))
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(301)} | {800: 800, 900: 800}


def removed_bytes(texts):
    raw = [(t or "").encode() for _, t in texts]
    times = Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    out = []
    for (key, _), b in zip(texts, raw, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if times[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        out.append((key, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("large", [10_000, 2])
def test_repeated_strings(spark, sf_dir, large):
    texts = [(r.doc_id, r.text) for r in documents(spark, sf_dir).limit(90).collect()]
    p = "".join(f"{i * i:x}é" for i in range(200))
    texts += [(1000, p[:230] + "a"), (1001, "b" + p[:230]), (1002, p[3:205]), (1003, p[:190]), (1004, None), (1005, "")]
    texts += [(1006, "ab" * 400), (1007, "x" * 199), (1008, "y" * 200), (1009, "z" * 201), (1010, p + "q" + p), (1011, "tail " + "ab" * 150)]
    texts += [(1012, "copy" * 60 + str(1)), (1013, "copy" * 60 + str(1))]
    docs = frame(spark, texts).withColumn("row", F.lit(7)).withColumn("low", F.lit("x"))
    got = sorted((tuple(r) for r in suffix_dedup.removed(docs, large).collect()), key=repr)
    assert got == removed_bytes(texts)


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    text = "".join(chr(97 + (i * i * 7 + i // 13) % 26) for i in range(3000))
    whole = suffix_dedup.anchors([text.encode()])[0]
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    for a, b in zip(whole, suffix_dedup.anchors([text.encode()])[0], strict=True):
        assert (a == b).all()


def test_equal_rows_are_copies(spark):
    text = "".join(f"{i} " for i in range(100))
    got = suffix_dedup.removed(frame(spark, [(1, text), (1, text), (None, "short")])).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in got) == [(5, 0), (len(text), len(text)), (len(text), len(text))]
    assert suffix_dedup.removed(frame(spark, [(1, "a")]).limit(0)).count() == 0


def kept_lines(texts, enough):
    per, names = [], defaultdict(list)
    for key, text in sorted(texts, key=lambda x: x[0]):
        lines = [] if text is None else text.split("\n")
        n = [len(WORD.findall(x)) for x in lines]
        runs = set()
        for p in range(len(lines)):
            runs |= {next(((p, e + 1) for e in range(p, len(lines)) if sum(n[p : e + 1]) >= enough), None)}
            runs |= {next(((b, p + 1) for b in range(p, -1, -1) if sum(n[b : p + 1]) >= enough), None)}
        runs -= {None}
        for a, b in runs:
            names[tuple(lines[a:b])].append((key, a))
        per.append((key, lines, runs))
    out = {}
    for key, lines, runs in per:
        gone = {i for a, b in runs if min(names[tuple(lines[a:b])]) < (key, a) for i in range(a, b)}
        out[key] = (len(lines), len(gone), hashlib.sha256("\n".join(x for i, x in enumerate(lines) if i not in gone).encode()).hexdigest())
    return out


@pytest.mark.parametrize("enough", [50, 7])
def test_repeated_lines(spark, sf_dir, enough):
    texts = [(r.doc_id, r.text) for r in documents(spark, sf_dir).limit(120).collect()]
    texts += [(500, None), (501, ""), (502, "\n\n\n"), (503, "a b c d\n\ne f g h\ni"), (504, "x\na b c d\n\ne f g h\ni"), (505, "one two three four\n" * 40)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in line_dedup.summary(frame(spark, texts), enough).collect()}
    assert got == kept_lines(texts, enough)


def test_line_dedup_keeps_columns_and_drops_emptied_documents(spark):
    run = "\n".join(f"line {i} has a few words in it" for i in range(12))
    docs = frame(spark, [(1, run), (2, run), (3, "own\n" + run + "\nend"), (4, None), (None, "x")]).withColumn("runs", F.lit(1))
    kept = line_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.collect()} == {1: run, 3: "own\nend", 4: None, None: "x"}


def test_line_dedup_runs_no_python(spark, sf_dir, plan):
    shape = plan(line_dedup.summary(documents(spark, sf_dir)))
    assert "Python" not in shape and "Arrow" not in shape and "Pandas" not in shape
