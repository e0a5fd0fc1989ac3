"""Registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from logstow.llm.collocations import phrase_collocations
from logstow.llm.language_id import language_id
from logstow.llm.merkle import merkle_manifest
from logstow.llm.mixing import mixing
from logstow.llm.packing import best_fit_packing
from logstow.llm.pii import pii
from logstow.llm.quality_classifier import quality_classifier
from logstow.llm.quality_rules import quality_rules
from logstow.llm.secrets import secret_scan
from logstow.llm.sentencepiece_codec import digest_documents
from logstow.llm.simhash import simhash_near_dedup
from logstow.llm.sql import COLLOCATIONS, MERKLE, QUALITY_RULES, TOP_K
from logstow.llm.suffix_dedup import suffix_dedup
from logstow.llm.tables import documents
from logstow.llm.topk_search import is_query, top_k


def piece_model() -> str:
    """Where the tokenizer's file lies on every machine."""
    return public_tokenizers.path("piece_bpe_32k.model")


def word_tokenizer() -> str:
    """Where the packing's tokenizer lies on every machine."""
    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier(documents(spark, sf_dir), labels)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(documents(spark, sf_dir), piece_model())


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing(documents(spark, sf_dir))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.filter(is_query()))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(documents(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(documents(spark, sf_dir))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(documents(spark, sf_dir), word_tokenizer())


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_collocations(documents(spark, sf_dir))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_mixing": op5_mixing,
    "op6_topk_search": op6_topk_search,
    "op7_pii": op7_pii,
    "op8_language_id": op8_language_id,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_phrase_collocations": op13_phrase_collocations,
}

LLM_ORACLE: dict[str, str] = {
    "op3_quality_rules": QUALITY_RULES,
    "op6_topk_search": TOP_K,
    "op11_merkle_manifest": MERKLE,
    "op13_phrase_collocations": COLLOCATIONS,
}
