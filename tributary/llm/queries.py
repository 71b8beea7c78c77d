"""The queries of this subpackage. The SQL that some must agree with is in oracles.py."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bpe, embeddings, exact_dedup, language, licenses, mixing, pii, sharding, simhash, substring
from tributary.llm.common import read


def bpe_path() -> str:
    """Where the vocabulary lies: TRIBUTARY_BPE, or the public tokenizers' file."""
    if path := os.environ.get("TRIBUTARY_BPE"):
        return path
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_dedup(read(spark, sf_dir, "embeddings"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("uid")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_encode(read(spark, sf_dir, "documents"), bpe_path())


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(read(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents")).drop("row")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_embedding_near_dedup, op2_language_id, op3_mix_sources, op4_license_scan, op5_bpe, op6_exact_dedup, op7_substring_dedup, op8_simhash_near_dedup, op9_shard, op10_pii)}
