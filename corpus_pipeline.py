"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing to target weights, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows to the shared folder and
reads them again for the next one. All stages but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bpe, exact_dedup, language, mixing, simhash
from tributary.llm.common import discard, kept_rows, read, stage
from tributary.llm.queries import bpe_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: texts that are null, empty or have no letter. Others stay, also where nothing can be learnt.

    Repeated rows are judged one by one, an empty table stays empty, texts may be of any length, columns may have any names.
    """
    return language.with_language(docs).where("letters").select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the smallest doc_id (null last; of repeated rows one).

    Null and empty texts are one group. An empty table stays empty; columns may have any names.
    """
    return kept_rows(docs, exact_dedup.exact_dedup(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, the one with the smallest doc_id (null last; of repeated rows one).

    Texts without words link with each other. An empty table stays empty; columns may have any names.
    """
    return kept_rows(docs, simhash.simhash_dedup(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, whole, by output shard and each shard shuffled.

    A null source is one of its own; documents without words are drawn with their block; repeated rows are drawn one by
    one. An empty table stays empty; columns may have any names.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of ids and of the decoded text, a row per row of docs: null and empty texts have no tokens, long ones are not cut. Other columns are ignored."""
    return bpe.bpe_encode(docs, bpe_path())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]

#: Fingerprint links, language prototypes and BPE are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        before, docs = docs, stage(function(spark, docs, sf_dir), name)
        discard(before)
    return docs
