"""A corpus cleaned in five stages, each one operator; every stage is written and read again.

quality -> repeated lines -> near duplicates -> benchmark items -> tokens. Stages
take (spark, docs, sf_dir) and, but for the last, return the columns of documents.
Rows with null or empty text pass the quality stage by the sample's share of good
documents, have no lines to lose, link with nothing, hold no item, and have no
tokens. Clean documents reach the end with their text as it was, but for line runs that
stand earlier.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weatherloom.llm import byte_bpe, decontaminate, line_dedup, ngram_join, quality
from weatherloom.llm.common import documents
from weatherloom.session import cut_lineage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned on the given labels and this stage's documents; the rejected go."""
    weights = quality.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, weights)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_copies(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def without_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_duplicates),
    ("benchmark decontamination", without_benchmark_items),
    ("byte-level BPE", tokenised),
]

#: SQL cannot score a network; tests hold each stage against brute force on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each one's rows written to the shared folder and read again."""
    return reduce(lambda docs, stage: cut_lineage(stage[1](spark, docs, sf_dir)), STAGES, documents(spark, sf_dir))
