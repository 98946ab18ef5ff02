"""Fingerprints, benchmark search, chat windows, tokens, quality, language."""

from __future__ import annotations

import hashlib
import random
import re
import struct

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from weatherloom.llm import byte_bpe, chat, decontaminate, fingerprints, language, quality, token_counts
from weatherloom.llm.common import documents, shingle_stream

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = "ab '’sS\n\t \r\x1c\x85\xa0 é漢字0१½Ⅷ_-!<|>😀éßİΣÅ‍﻿"


def frame(spark, texts, lang=None):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t in texts], SCHEMA)


def odd_texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(n)]


EDGES = [None, "", " ", "\n\n", "a", "A" * 3000, "x " * 4000, *odd_texts(60)]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def pair_hash(*values):
    import xxhash

    h = 42
    for v in values:
        h = xxhash.xxh64(struct.pack("<q", v), seed=h).intdigest()
    return signed(h)


def test_edited_texts(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in documents(spark, sf_dir).limit(60).collect()]
    texts += [(1000 + 7 * i, t) for i, t in enumerate(EDGES)]
    clashing = frame(spark, texts).withColumns({c: F.lit(1) for c in ("range", "hash", "own", "_winnow", "_first")})
    got = {r.doc_id: r for r in fingerprints.edited(clashing).collect()}
    texts = sorted((i, t or "") for i, t in texts)
    assert len(got) == len(texts)
    for i, (key, text) in enumerate(texts):
        after, half = texts[(i + 1) % len(texts)][1], len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        assert (got[key].n_chars, got[key].edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())


def test_fingerprints_over_many_ranges_ties_and_missing_ids(spark, monkeypatch, plan):
    monkeypatch.setattr(fingerprints, "PER_RANGE", 4)
    texts = [(i * i, f"text {i} " * 9) for i in range(300)] + [(50, "tie"), (50, "tie"), (50, "tie two"), (None, "no id")]
    made = fingerprints.edited(frame(spark, texts))
    assert "Python" not in plan(made) and "Arrow" not in plan(made)
    got = made.collect()
    assert len(got) == len(texts)
    by_id = {r.doc_id: r for r in got if r.doc_id != 50}
    for i in range(8, 299):
        text, after = f"text {i} " * 9, f"text {i + 1} " * 9
        changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert by_id[i * i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
    last = texts[299][1]
    assert by_id[299 * 299].edited_sha256 == hashlib.sha256((last[: len(last) - len(last) // 2] + "no id"[: len(last) // 2]).encode()).hexdigest()
    assert fingerprints.edited(frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_benchmark_items_are_found(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(14, 60)))) for i in range(30)]
    items += [(40, "two words"), (41, None), (42, ""), (43, items[0][1]), (44, "a b c d e " * 6)]
    texts = []
    for i in range(60):
        around = [rng.choice(vocabulary) for _ in range(rng.randint(0, 200))]
        if i % 2:
            own = items[i % 30][1].split()
            if i % 4 == 3:
                own[rng.randrange(len(own))] = "changed"
            at = rng.randint(0, len(around))
            around[at:at] = own
        texts.append((i, " ".join(around).upper()))
    texts += [(100, None), (101, ""), (102, "two  WORDS"), (103, "a b c d e " * 20), (103, "a b c d e " * 20)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, texts).withColumn("item_id", F.lit("x"))
    index = decontaminate.Index(tuple((i, t) for i, t in items if t))
    want = {}
    for key, text in texts:
        hashes = shingle_stream([text])[0]
        for item, size in enumerate(index.sizes.tolist()):
            starts = range(len(hashes) - -(-size * 75 // 100) + 1)
            best = max((index.similarity(item, hashes[s : s + size]) for s in starts), default=0)
            if best >= 0.75:
                want[key, index.ids[item]] = best
    for block in (5000, 7):
        got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.matches(docs, benchmark, block=block).collect()}
        assert got == want
    assert len(want) > 20
    left = decontaminate.clean(docs, benchmark)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i, _ in texts} - {k for k, _ in want}
    assert decontaminate.matches(docs, benchmark.limit(0)).count() == 0


def test_multi_index_holds_all_pairs_within_the_radius():
    rng = np.random.default_rng(1)
    index = decontaminate.Index(tuple((i, " ".join(f"i{i}w{j}" for j in range(20))) for i in range(5)))
    prints = []
    for i in range(5):
        for flips in (0, 5, 39, 40):
            bits = np.unpackbits(index.prints[i])
            bits[rng.choice(128, flips, replace=False)] ^= 1
            prints.append(np.packbits(bits))
    window, item = index.within(np.array(prints), 16)
    assert set(zip(window.tolist(), item.tolist(), strict=True)) == {(4 * i + k, i) for i in range(5) for k in range(3)}


X = "<|im_end|><|im_start|>assistant ok"


def test_chat_windows_come_back(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = [(-1, 0, "user", X), (-1, 1, "assistant", X), (-2, 0, "r\n<|im\\", "a\\|<|<\\|<\\\\|im_end|>"), (-2, 1, "assistant", None)]
    hard += [(-2, 2, None, "\n<|im_end|>\n<|im_start|>user\n")] * 2 + [(None, None, "assistant", "z"), (-3, 0, "system", "s" * 5000)]
    hard += [(-3, i, "assistant" if i % 2 else "user", "word " * (i % 300)) for i in range(1, 700)]
    hard += [(-4, i, "system" if i == 0 else "assistant" if i % 2 else "user", f"turn {i} " * 30) for i in range(60)]
    rows = given.unionByName(spark.createDataFrame(hard, given.schema))
    made = chat.windows(rows.withColumn("window", F.lit("x")).withColumn("place", F.lit(1)))
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    talks = {}
    for r in rows.collect():
        talks.setdefault(r.conv_id, []).append((-1 if r.turn is None else r.turn, r.role or "", r.text or ""))
    assert set(got) == set(talks)
    for key, turns in talks.items():
        turns.sort()
        said = "".join(t for _, role, t in turns if role == "assistant")
        want = hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest()
        r = got[key]
        assert (r.n_turns, r.turns_sha256) == (len(turns), want)
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    own = made.filter("conv_id = -4").orderBy("window").collect()
    assert len(own) > 2 and all(w.n_tokens <= chat.BUDGET for w in own)
    for w in own[1:]:  # the system turn, then the turns just before
        roles = chat.turns_in(w.formatted)[: w.n_repeated]
        assert roles[0] == ("system", "turn 0 " * 30) and len(roles) == 1 + chat.HISTORY
    assert chat.read_back(chat.windows(given.limit(0))).count() == 0


def test_unescaping_is_the_inverse(spark):
    texts = ["<|", "<\\|", "<\\\\|x", "a<b|c", "<<||>", "\\n", "", *odd_texts(100)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped("t").alias("e"), chat.escaped_role("t").alias("r"))
    for r in df.collect():
        assert chat.unescaped(r.e) == r.t and "<|" not in r.e
        assert chat.unescaped_role(r.r) == r.t and "\n" not in r.r and "<" not in r.r


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_byte_bpe_equals_the_library(spark, sf_dir):
    import tiktoken

    texts = [(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()] + [(9000 + i, t) for i, t in enumerate(EDGES)]
    ranks = byte_bpe.codec(RANKS, public_tokenizers.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = frame(spark, texts).withColumn("ids", F.lit(1))
    got = {r.doc_id: tuple(r)[1:] for r in byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()}
    for key, text in texts:
        ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        whole = hashlib.sha256((text or "").encode()).hexdigest()
        assert got[key] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), whole)
    ids = byte_bpe.encoded(docs, RANKS, public_tokenizers.PATTERN)
    back = {r.doc_id: bytes(r.bytes) for r in byte_bpe.decoded(ids, RANKS, public_tokenizers.PATTERN).collect()}
    assert back == {key: (text or "").encode() for key, text in texts}
    assert byte_bpe.digests(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_perfect_hash_is_minimal():
    for n in (1, 2, 5, 1000):
        keys = [f"key {i}".encode() for i in range(n)]
        made = byte_bpe.MinimalPerfectHash(keys)
        assert sorted(made.slots) == list(range(n)) and [made.keys[made.find(k)] for k in keys] == keys
        assert made.find(b"no key") is None


def test_token_counts_equal_the_library(spark, sf_dir, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    odd = [*EDGES, "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "it's we'll ''s 'S", "x" * 500]
    texts = [(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()] + [(9000 + i, t) for i, t in enumerate(odd)]
    want = {key: len(library.encode(text or "", add_special_tokens=False).ids) for key, text in texts}
    got = token_counts.counted(frame(spark, texts).withColumn("n_tokens", F.lit("x")), path).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert {r.doc_id: r.n_bytes for r in got} == {key: len((text or "").encode()) for key, text in texts}
    monkeypatch.setattr(token_counts, "CHUNK", 20)
    own = token_counts.Counter(path)
    assert all(own.of_text(text or "") == want[key] for key, text in texts)


def test_quality_on_held_out_documents(spark):
    big = "/root/testdata/sf0.1"
    docs, labels = documents(spark, big), spark.read.parquet(f"{big}/labels.parquet")
    weights = quality.learned(docs, labels)
    marked = docs.join(labels, "doc_id").filter(language.held_out())
    scored = quality.scored(marked, weights).join(labels, "doc_id")
    right = scored.select(F.avg(((F.col("score") >= quality.THRESHOLD).cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.97
    odd = quality.scored(frame(spark, list(enumerate(EDGES))).withColumn("score", F.lit("x")), weights).collect()
    assert len(odd) == len(EDGES) and all(0 <= r.score <= 1 for r in odd)
    kept = quality.accepted(docs.limit(50).withColumn("score", F.lit("x")), weights)
    assert kept.columns == [*docs.columns, "score"] and kept.count() > 30
    nothing = quality.learned(docs, labels.limit(0))
    assert {r.score for r in quality.scored(docs.limit(5), nothing).collect()} == {0.5}


def test_scores_cover_the_whole_text(spark):
    good, bad = ["calm words in a row here"] * 40, ["LOUD!! LOUDER!! WORDS!!"] * 40
    weights = quality.fitted([f"{g} {i} " * 9 for i, g in enumerate(good)] + [f"{b} {i} " * 9 for i, b in enumerate(bad)], [1] * 40 + [0] * 40)
    calm = "calm words in a row here " * 2000
    assert quality.probability(calm, weights) > 0.5
    assert quality.probability(calm + "LOUD!! LOUDER!! WORDS!! " * 40, weights) < quality.probability(calm, weights)


def test_language_on_held_out_documents(spark):
    docs = documents(spark, "/root/testdata/sf0.1")
    found = language.identified(docs, language.dictionaries(docs)).join(docs.select("doc_id", "lang", "n_chars"), "doc_id")
    right = found.filter(language.held_out()).select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    made = language.identified(frame(spark, [(1, None), (2, ""), (3, "123 !?"), (4, "le la"), (4, "le la")]), language.dictionaries(docs))
    assert [r.lang_pred for r in made.orderBy("doc_id").collect()][:3] == ["und"] * 3
    assert language.dictionaries(frame(spark, [(1, "a"), (2, "b")])) == {}
    assert {r.lang_pred for r in language.identified(docs.limit(3), {}).collect()} == {"und"}
