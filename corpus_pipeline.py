"""The corpus pipeline: quality, near duplicates, benchmark passages, personal data, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from metframe.llm import bpe, decontaminate, jaccard_join, pii, quality
from metframe.llm.queries import VOCABULARY, table
from metframe.llm.text import without
from metframe.session import cut_lineage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling keeps."""
    scored = quality.resampled(docs, table(spark, sf_dir, "labels"))
    return without(docs, scored.where("not kept"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard_join.one_of_each(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without(docs, decontaminate.contained(docs, table(spark, sf_dir, "benchmark")))


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked."""
    return pii.masked(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and digests of ids and decoded text."""
    return bpe.encoded(docs, public_tokenizers.path(VOCABULARY)).drop("decoded")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", distinct_documents),
    ("decontamination", clean_of_benchmark),
    ("personal_data", masked_documents),
    ("tokens", tokens),
]

#: The quality model and the tokenizer cannot be said in SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
