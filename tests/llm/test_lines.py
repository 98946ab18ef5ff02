"""Line dedup on many lines, on columns of any name, and its merging of runs."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from weatherloom.llm import line_dedup


def test_runs_are_merged_like_plain_python(spark):
    rng = random.Random(1)
    cases = [[]]
    for _ in range(200):
        cases.append([(a, a + rng.randint(1, 6)) for a in (rng.randint(0, 60) for _ in range(rng.randint(1, 25)))])
    df = spark.createDataFrame(list(enumerate(cases)), "i int, r array<struct<from:int,to:int>>").repartition(2)
    for row in df.select("i", F.expr(line_dedup._merged("r")).alias("m")).collect():
        want = []
        for a, b in sorted(cases[row.i]):
            if want and a <= want[-1][1]:
                want[-1][1] = max(want[-1][1], b)
            else:
                want.append([a, b])
        assert [[x["from"], x["to"]] for x in row.m or []] == want


def test_columns_of_any_name_survive(spark):
    names = ["_hash", "_doc", "_gone", "_lines", "_runs", "row", "lines", "gone", "runs", "own_id", "row_hash", "levels"]
    shared = "\n".join(f"line {i} of a passage with several words in it" for i in range(12))
    rows = [(1, f"begin\n{shared}", *range(12)), (2, f"{shared}\nend", *range(12)), (None, None, *range(12)), (3, "", *range(12))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    kept = line_dedup.without_copies(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    got = {r.doc_id: r for r in kept.collect()}
    assert got[1].text == rows[0][1] and got[2].text == "end" and got[None].text is None and got[3].text == ""
    assert all(tuple(r[n] for n in names) == tuple(range(12)) for r in got.values())
    assert line_dedup.without_copies(docs.limit(0)).count() == line_dedup.summary(docs.limit(0)).count() == 0


def test_time_grows_with_the_lines(spark, tmp_path):
    lines = [f"line {i % 50_000} has some seven words here" for i in range(100_000)]
    texts = [(1, "\n".join(lines)), (2, "x\n" + "\n".join(lines[20_000:60_000]))]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/long")
    began = time.time()
    got = {r.doc_id: r for r in line_dedup.summary(spark.read.parquet(f"{tmp_path}/long")).collect()}
    assert (got[1].n_lines, got[1].n_removed, got[1].n_runs) == (100_000, 50_000, 1)
    assert (got[2].n_removed, got[2].n_runs) == (40_000, 1)
    assert time.time() - began < 60
