"""The corpus pipeline: language ID, near duplicates, repeated passages, benchmark leaks, tokenization.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

Defined results: documents of null text or without a letter go in the first stage; equal rows are copies, of which one
stays; columns beside those of documents are carried along, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelark.llm.common import checkpointed, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no letter, or no shorter a code than plain bytes) go; null languages are named."""
    from tidelark.llm.langid import with_language

    return with_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 or more of their 5-word shingles) stays: the one with the least id."""
    from tidelark.llm.nearcopies import one_per_group

    return one_per_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand in a document with a smaller id are cut."""
    from tidelark.llm.substrings import deduplicated

    return deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a benchmark window are cut, from the first to the last of each run."""
    from tidelark.llm.decontam import decontaminated

    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's piece ids and their decoding, as digests."""
    from tidelark.llm.piece_codec import encode_digests

    return encode_digests(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("tokenization", tokenization),
]

#: Model, graph and suffix stages have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
