"""The queries of this package (``QUERIES``) and their DuckDB SQL (``ORACLE``).

Each query applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, collocations, embedding_dedup, fingerprint, langid, lm, manifest, mixing, quality, separator_scan, simhash_dedup, token_files, warc
from .common import table
from .oracles import ORACLE  # noqa: F401


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_report(table(spark, sf_dir, "pages"))


def op4_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op5_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separator_scan.token_count_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"))


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scoring_report(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_report(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocation_report(table(spark, sf_dir, "documents"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_report(table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_bpe_tree": op2_bpe_tree,
    "op3_warc_salvage": op3_warc_salvage,
    "op4_quality_divergence": op4_quality_divergence,
    "op5_separator_scan": op5_separator_scan,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_language_id": op7_language_id,
    "op8_kneser_ney": op8_kneser_ney,
    "op9_fingerprints": op9_fingerprints,
    "op10_mixing": op10_mixing,
    "op11_collocations": op11_collocations,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

