"""Ranked lexical search against the formula in Python's integers."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from weatherloom.llm import lexical_search as S

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, n int, terms string"
ITEMS = "item_id long, text string, number int"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=20):
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, counts in held:
            m = 100 - 25 + 25 * sum(counts.values()) * n_docs // n_terms
            score = 0
            for t in terms(text):
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1000000000 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        scores.sort()
        out += [(item_id, r + 1, s[3], -s[0]) for r, s in enumerate(scores[:top])]
    return sorted(out, key=repr)


def found(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "x", 3, "y") for i, t in docs], DOCS).repartition(5)
    b = spark.createDataFrame([(i, t, 7) for i, t in items], ITEMS)
    return sorted((tuple(r) for r in S.search(d, b, **kw).collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "naïve", "UPPER", "a_b", "x y"])
    share = 1 / np.arange(1, len(words) + 1)
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 40), p=share / share.sum()))) for i in range(300)]
    docs += [(i, docs[11][1]) for i in range(300, 360)]  # more copies than places
    docs += [(5, docs[5][1]), (None, docs[5][1]), (None, None), (400, None), (401, ""), (402, "... !?"), (403, "w1 " * 50_000)]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 12)))) for i in range(30)]
    items += [(3, items[3][1]), (None, "w2 w2 w2"), (90, None), (91, ""), (92, "unknown"), (93, "W1,w1;w1"), (94, docs[11][1])]
    return docs, items


def test_like_the_formula(spark, corpus):
    docs, items = corpus
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, items, top=3) == plain(docs, items, top=3)


def test_blocks_of_items_make_no_difference(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(S, "BLOCK_ITEMS", 15)
    assert found(spark, docs, items) == plain(docs, items)
    monkeypatch.setattr(S, "BLOCK_BYTES", 300)
    assert found(spark, docs, items[:8]) == plain(docs, items[:8])


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, [(1, None)], [(1, "a")]) == []
    assert found(spark, [(1, "a")], [(1, None), (2, "b")]) == []


@pytest.mark.parametrize("columns,exact", [(4096, 1 << 53), (7, 1 << 53), (4096, 40_000 * S.HIGHEST_IMPACT), (3, 9_000 * S.HIGHEST_IMPACT)])
def test_tiles_keep_sums_exact(monkeypatch, columns, exact):
    monkeypatch.setattr(S, "TILE_TERMS", columns)
    monkeypatch.setattr(S, "EXACT", exact)
    rng = np.random.default_rng(columns)
    size = 40
    counts = [Counter({f"t{t}".encode(): int(rng.integers(1, 30)) for t in rng.choice(size, 12, replace=False)}) for _ in range(9)]
    vocabulary = {f"t{t}".encode(): t for t in range(size)}
    weights = {t: int(rng.integers(0, 3000)) for t in range(size)}
    tiles = S.Tiles(counts, vocabulary, weights)
    most = exact // S.HIGHEST_IMPACT
    for at, (own, _) in enumerate(tiles.tiles):
        assert len(own) <= columns and len(set(own.tolist())) == len(own)
        assert tiles.dense(at).sum(axis=0).max() <= most
    own = [rng.choice(size, rng.integers(1, 20), replace=False) for _ in range(50)]
    values = [rng.integers(1, S.HIGHEST_IMPACT, len(o)) for o in own]
    starts = np.concatenate(([0], np.cumsum([len(o) for o in own])))
    got = S.tile_scores(tiles, starts, np.concatenate(own), np.concatenate(values), size, {})
    for d in range(50):
        impact = dict(zip(own[d].tolist(), values[d].tolist(), strict=True))
        for i, c in enumerate(counts):
            assert got[d, i] == sum(n * weights[vocabulary[t]] * impact.get(vocabulary[t], 0) for t, n in c.items())


def test_best_keeps_ties_by_id():
    rng = np.random.default_rng(2)
    scores, ids = rng.integers(0, 4, (400, 5)), rng.permutation(400)
    best = S.Best(5, 20)
    for start in range(0, 400, 37):
        best.add(scores[start : start + 37], ids[start : start + 37])
    for item in range(5):
        want = sorted((-s, d) for s, d in zip(scores[:, item].tolist(), ids.tolist(), strict=True) if s > 0)[:20]
        assert [(-s, d) for s, d in zip(*(x.tolist() for x in best.kept[item]), strict=True)] == want


def test_words_over_piece_borders(monkeypatch):
    text = ("Ab cdé-f " * 500).encode()
    whole = S.term_counts(text)
    monkeypatch.setattr(S, "PIECE", 7)
    assert S.term_counts(text) == whole and whole[0][b"ab"] == 500 and whole[1] == 1500
