"""The registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import document_toxicity

    return document_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import document_quality

    return document_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import repeat_digests

    return repeat_digests(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import language_ids

    return language_ids(table(spark, sf_dir, "documents"))


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import hilbert_shards

    return hilbert_shards(table(spark, sf_dir, "documents"))


def op9_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .piece_codec import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import exact_topk

    return exact_topk(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_simhash, op3_quality, op4_suffix_dedup, op5_decontamination, op6_token_counts, op7_language_id, op8_hilbert_shards, op9_piece_codec, op10_exact_topk)}
ORACLE_SQL: dict[str, str] = {}
