"""The registered queries: SQL twins, the pipeline, stage by stage."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from weatherloom.llm import queries
from weatherloom.llm.common import documents


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n != "pipeline") == list(range(1, 14))
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    columns, got = compare.spark_rows(entry.queries()[name](spark, sf_dir))
    want_columns, want = compare.sql_rows(compare.connect(sf_dir), entry.oracle_sql()[name])
    assert (columns, got) == (want_columns, want)


def test_pipeline_stages(spark, sf_dir):
    docs = documents(spark, sf_dir)
    shape, size = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, sf_dir))
        assert docs.columns == shape
        assert 0 < docs.count() <= size
        size = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == size and corpus_pipeline.run(spark, sf_dir).count() == size


def test_pipeline_of_an_empty_table(spark, sf_dir):
    docs = documents(spark, sf_dir).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, sf_dir))
    assert docs.count() == 0
