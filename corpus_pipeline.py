"""A training corpus from raw documents: five operators in a row, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet below the shared folder and reads it
again for the next, so that a lost executor never costs more than one stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from labelspark.llm import bpe, langid, mixing, secrets, simhash
from labelspark.llm.common import shared_folder, table

TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that fit no language."""
    return langid.accepted(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near duplicates."""
    return simhash.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, its secrets replaced by a mark and n_chars counted anew where that changed it."""
    return secrets.redacted(docs, chars_col="n_chars")


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that all sources weigh the same, about as many characters in all, in random order."""
    return mixing.sampled_rows(docs)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("source_mixture", source_mixture),
    ("bpe_codec", bpe_codec),
]

#: SQL can't express the first and the last stage; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table documents."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
