"""Corpus pipeline: quality, language, near duplicates, mixing to source weights, and BPE encoding of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lociq.llm.common import stored, table
from lociq.llm.jaccard_join import one_of_each
from lociq.llm.language_id import known_language_only
from lociq.llm.mixing import mixed_documents
from lociq.llm.quality import good_documents
from lociq.llm.queries import tokenizer_path
from lociq.llm.trie_bpe import bpe_digests


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have letters and are near to a learned language."""
    return known_language_only(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents, the one with the smallest doc_id."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return bpe_digests(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("mixing", mixing), ("encoding", encoding)]

#: The classifiers and the tokenizer cannot be written in SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
