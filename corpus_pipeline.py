"""The corpus pipeline: documents through five operators of ``unfurl.llm``, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from unfurl.llm import bpe, langid, mixing, quality, simhash_dedup
from unfurl.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.kept_documents(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found."""
    return langid.accepted_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_dedup.deduplicated(docs, simhash_dedup.SHINGLE, simhash_dedup.DISTANCE)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``token_ids`` in place of the text."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=tuple(c for c in docs.columns if c != "text"))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixing_to_weights),
    ("byte-level BPE encoding", token_ids),
]

#: SQL cannot express these stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{i}")
    return docs
