"""Small sets share keys wherever their hashes lie."""

from __future__ import annotations

import numpy as np

from weatherloom.llm import ngram_join
from weatherloom.llm.common import shingle_sets
from weatherloom.llm.ngram_join import levels, sketch_keys


def test_sets_that_fall_into_one_cell_share_most_keys():
    for large in range(1, 43):
        whole = np.arange(1, large + 1, dtype=np.uint64)  # one cell in every band
        for small in range(-(-3 * large // 4), large + 1):
            for left_out in (whole[:small], whole[large - small :]):
                bands = set(levels(small)) & set(levels(large))
                if max(levels(small)) <= ngram_join.EXACT:
                    assert bands
                    for level in bands:
                        x, y = sketch_keys(left_out, level), sketch_keys(whole, level)
                        assert len(x) == small and len(y) == large and len(np.intersect1d(x, y)) == small
                        assert small > small // 4 + large // 4  # more than may go as hot


def test_three_of_four_shingles_in_one_cell_link(spark):
    def crowded(texts):  # all hashes into the lowest cell
        return [np.sort(s >> np.uint64(12)) for s in shingle_sets(texts)]

    texts = ["a b c d e f g", "a b c d e f g h"]
    small, large = crowded(texts)
    assert (len(small), len(large)) == (3, 4)
    assert len(np.intersect1d(sketch_keys(small, 2), sketch_keys(large, 2))) == 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.component_id for r in ngram_join.near_duplicates(docs).collect()} == {0}
