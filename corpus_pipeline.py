"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reportweave.llm import bpe, exact_dedup, language_id, mixing, near_dedup
from reportweave.sources.stored import store
from reportweave.sources.tables import read_table

RANKS = "byte_bpe_50k.tiktoken"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language for certain, go."""
    return language_id.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest id stays."""
    return exact_dedup.keep_first(docs).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the smallest id stays."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the wanted shares of sources, languages and topics."""
    return mixing.keep_mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit integers).

    All ids are decoded again; a text that they do not give back is an error.
    """
    path = public_tokenizers.path(RANKS)
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN, verify=True)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Raked sampling aside, neither the language model nor the token ids can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
