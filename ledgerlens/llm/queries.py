"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import chat, filter_audit, fingerprints, hilbert, language, mixing, ngram_join, packing, privacy, quality, spelling, token_counts, topk
from ledgerlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return deco


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_private_data")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.find(table(spark, sf_dir, "documents"))


@register("op2_source_mixing", mixing.SHARES_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(table(spark, sf_dir, "documents"))


@register("op3_document_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbour_fingerprints(table(spark, sf_dir, "documents"))


@register("op4_importance_resampling")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op5_ngram_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"))


@register("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


@register("op7_exact_top_k", topk.TOP_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@register("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


@register("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@register("op10_chat_formatting", chat.CHATS_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@register("op11_hilbert_sharding", hilbert.ASSIGN_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.assign(table(spark, sf_dir, "documents"))


@register("op12_filter_audit", filter_audit.AUDIT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@register("op13_spelling_variants", spelling.VARIANTS_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
