"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lociq.llm.common import table
from lociq.llm.divergence import ORACLE as AUDIT_ORACLE
from lociq.llm.exponion import ORACLE as CLUSTERS_ORACLE
from lociq.llm.mixing import ORACLE as MIXING_ORACLE
from lociq.llm.secret_scan import ORACLE as SECRETS_ORACLE


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.mixing import mixed_amounts

    return mixed_amounts(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


def op4_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.vector_search import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.trie_bpe import bpe_digests

    return bpe_digests(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.quality import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.language_id import identify_languages

    return identify_languages(table(spark, sf_dir, "documents"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.html_extract import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


def op9_media_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.media_copies import media_groups, rendered_media

    return media_groups(rendered_media(table(spark, sf_dir, "embeddings")))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.token_store import token_store

    return token_store(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.exponion import clusters

    return clusters(table(spark, sf_dir, "embeddings"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.secret_scan import secret_digests

    return secret_digests(table(spark, sf_dir, "documents"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lociq.llm.divergence import source_audit

    return source_audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_token_counts": op2_token_counts,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_vector_search": op4_vector_search,
    "op5_bpe": op5_bpe,
    "op6_quality": op6_quality,
    "op7_language_id": op7_language_id,
    "op8_html_extract": op8_html_extract,
    "op9_media_copies": op9_media_copies,
    "op10_token_store": op10_token_store,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_secret_scan": op12_secret_scan,
    "op13_source_audit": op13_source_audit,
}
ORACLES: dict[str, str] = {
    "op1_mixing": MIXING_ORACLE,
    "op11_centroid_clusters": CLUSTERS_ORACLE,
    "op12_secret_scan": SECRETS_ORACLE,
    "op13_source_audit": AUDIT_ORACLE,
}
