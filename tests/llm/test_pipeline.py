"""Each stage of the pipeline against brute force on what the stages before it kept."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from test_join import kept_lines, true_components, words

import corpus_pipeline
from weatherloom.llm import quality
from weatherloom.llm.common import documents

PLANTED = (10**9, "the planted passage of the benchmark stands here once more ")


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What goes into each stage and comes out of it: name -> (rows before, rows after)."""
    docs = documents(spark, sf_dir)
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first()["text"]
    first = docs.orderBy("doc_id").first().asDict()
    extra = [
        {**first, "doc_id": PLANTED[0], "text": PLANTED[1] + item},
        {**first, "doc_id": PLANTED[0] + 1, "text": "\n".join([first["text"], "and a word"])},
        {**first, "doc_id": PLANTED[0] + 2, "text": None},
        {**first, "doc_id": PLANTED[0] + 3, "text": ""},
    ]
    docs = corpus_pipeline.cut_lineage(docs.unionByName(spark.createDataFrame(extra, docs.schema)))
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.cut_lineage(stage(spark, docs, sf_dir))
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    got = [(r.doc_id, r.text) for r in df.collect()]
    assert len(got) == len({i for i, _ in got})
    return dict(got)


def test_the_rejected_go(spark, sf_dir, stages):
    before, after = stages["quality classifier"]
    weights = quality.learned(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = {i: t for i, t in texts(before).items() if quality.probability(t, weights) >= quality.THRESHOLD}
    assert texts(after) == want and 0 < len(want) < before.count()


def test_later_line_runs_go(stages):
    before, after = (texts(df) for df in stages["line dedup"])
    want = kept_lines(list(before.items()), 50)
    assert set(after) == {i for i, (n, gone, _) in want.items() if gone == 0 or gone < n}
    for key, text in after.items():
        assert hashlib.sha256((text or "").encode()).hexdigest() == want[key][2]
        assert (text is None) == (before[key] is None)


def test_one_of_each_component_stays(stages):
    before, after = (texts(df) for df in stages["n-gram Jaccard join"])
    parts = true_components(list(before.items()))
    assert after == {i: t for i, t in before.items() if parts[i][1] == i}


def shingles(text):
    own = words(text)
    return [tuple(own[i : i + 5]) for i in range(len(own) - 4)] if len(own) >= 5 else ([tuple(own)] if own else [])


def holds(text, item):
    """Whether a window of the item's size, or a shorter one at the end, is similar to it; windows that share nothing are passed over."""
    own, wanted = shingles(text), Counter(shingles(item))
    size = sum(wanted.values())
    near = {s for i, g in enumerate(own) if g in wanted for s in range(max(0, i - size + 1), i + 1)}
    for start in near:
        window = Counter(own[start : start + size])
        least, most = sum((window & wanted).values()), sum((window | wanted).values())
        if 4 * least >= 3 * most:
            return True
    return False


def test_documents_with_an_item_go(spark, sf_dir, stages):
    before, after = (texts(df) for df in stages["benchmark decontamination"])
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if r.text]
    want = {i: t for i, t in before.items() if not any(holds(t, item) for item in items)}
    assert after == want and len(want) < len(before)


def test_tokens_are_the_librarys(stages):
    before, after = stages["byte-level BPE"]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for key, text in texts(before).items():
        ids = library.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want[key] = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in after.collect()} == want
