"""Language by compression against a plain comparison of sizes; the sample's bounds."""

from __future__ import annotations

import random
import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from weatherloom.llm import language
from weatherloom.llm.common import documents

SCHEMA = "doc_id long, text string, lang string"
WORDS = {"aa": "kato hundo birdo fi", "bb": "ŝtono arbo rivero ü", "cc": "one two three four five"}


def made(count=40, seed=3):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(WORDS[lang].split(), k=rng.randint(3, 60))), lang) for i, lang in enumerate(rng.choices(list(WORDS), k=count))]


def learnable(rows):
    return [r for r in rows if r[1] and r[2] and zlib.crc32(str(r[0]).encode()) % 5]


def size_of(content, text):
    """Bytes of one text by the library's one-shot interface, with the dictionary loaded anew."""
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=language.LEVEL)
    coder = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)
    return len(coder.compress(text.lower().encode()))


def test_smallest_size_wins(spark):
    rows = [*made(), (900, None, "aa"), (901, "12 34", "bb"), (902, "", None), (3, "kato ŝtono one", "aa")]
    contents = language.dictionaries(spark.createDataFrame(rows, SCHEMA))
    want = []
    for key, text, _ in rows:
        if not text or not re.search(r"[^\W\d_]", text):
            want.append((key, "und", True))
            continue
        sizes = [(size_of(c, text), at, name) for at, (name, c) in enumerate(contents.items())]
        (low, _, name), (second, _, _) = sorted(sizes)[:2]
        want.append((key, name, second - low < language.MARGIN * low))
    got = language.identified(spark.createDataFrame(rows, SCHEMA), contents).collect()
    assert sorted((r.doc_id, r.lang_pred, r.rejected) for r in got) == sorted(want)


def test_whole_texts_are_learned(spark):
    rows = made(60)
    contents = language.dictionaries(spark.createDataFrame(rows + rows[:5], SCHEMA))
    frequent = {lang: sum(r[2] == lang for r in learnable(rows + rows[:5])) for lang in WORDS}
    assert list(contents) == sorted(WORDS, key=lambda name: (-frequent[name], name))
    for lang, content in contents.items():
        assert sorted(content.decode().split("\n")) == sorted({(r[0], r[1]): r[1] for r in learnable(rows) if r[2] == lang}.values())


@pytest.mark.parametrize("size", [200, 300, 1000])  # with less, some language has no text that fits
def test_the_bytes_hold_whole_texts(spark, size):
    rows = made(60)
    for lang, content in language.dictionaries(spark.createDataFrame(rows, SCHEMA), size=size).items():
        held = content.decode().split("\n")
        own = [r[1] for r in learnable(rows) if r[2] == lang]
        assert len(content) <= size and set(held) <= set(own)
        left = [t for t in own if t not in held]
        assert all(len(content) + 1 + len(t.encode()) > size for t in left)


def test_a_language_of_long_texts_only(spark):
    rows = [(i, "üé" * 500, "aa") for i in range(1, 9)]
    (content,) = language.dictionaries(spark.createDataFrame(rows, SCHEMA), size=101).values()
    assert content.decode() == "üé" * 25  # 101 bytes, less half a character


def test_the_most_frequent_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    rows = [(i, "some words here", "cc" if i % 3 else ("aa" if i % 2 else "bb")) for i in range(40)] + [(50, "lone", "zz")]
    counts = {lang: sum(r[2] == lang for r in learnable(rows)) for lang in ("aa", "bb", "cc")}
    assert list(language.dictionaries(spark.createDataFrame(rows, SCHEMA))) == sorted(counts, key=lambda n: (-counts[n], n))[:2]


def test_other_columns_and_empty_tables(spark, sf_dir):
    docs = documents(spark, sf_dir)
    contents = language.dictionaries(docs)
    clashing = docs
    for name in ("hash", "bytes", "rank", "n", "_group", "score", "rejected", "lang_pred"):
        clashing = clashing.withColumn(name, F.lit("x"))
    assert language.dictionaries(clashing) == contents
    got, want = (sorted(map(tuple, language.identified(d, contents).collect())) for d in (clashing, docs))
    assert got == want
    empty = docs.limit(0)
    assert language.dictionaries(empty) == {} and language.identified(empty, contents).count() == 0
