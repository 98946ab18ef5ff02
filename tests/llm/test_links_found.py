"""The count of links that were found does not call itself the number of links."""

from __future__ import annotations

from weatherloom.llm import ngram_join


def test_links_found_are_named_so(spark):
    text = "one two three four five six seven"
    made = ngram_join.near_duplicates(spark.createDataFrame([(1, text), (2, text), (3, text)], "doc_id long, text string"))
    assert made.columns == ["doc_id", "n_shingles", "component_id", "n_links_found"]
    assert {(r.component_id, r.n_links_found) for r in made.collect()} == {(1, 0)}  # equal sets are not counted
