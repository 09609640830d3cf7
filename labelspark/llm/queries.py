"""The registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from labelspark.llm import (
    alignment,
    bpe,
    chat,
    filter_audit,
    html_text,
    langid,
    mixing,
    pii,
    quality,
    secrets,
    sharding,
    simhash,
    winnowing,
)
from labelspark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op1_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


@query()
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query(secrets.oracle())
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(secrets.scan(table(spark, sf_dir, "documents")))


@query(sharding.oracle())
def op5_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


@query(quality.oracle())
def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


@query()
def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compared(table(spark, sf_dir, "documents"))


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query(mixing.oracle())
def op9_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixed(docs, keep_text=False).select("row.doc_id", "row.source", "copy", "shuffle_key")


@query()
def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.audited(table(spark, sf_dir, "documents"), *paths)


#: A conversation that says what the template says.
TEMPLATE_TALK = [(-7, turn, role, r"\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]


@query()
def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(TEMPLATE_TALK, "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.formatted(told.unionByName(own), public_tokenizers.path("byte_bpe_50k.json")))


@query(filter_audit.oracle())
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
