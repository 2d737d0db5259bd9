"""Corpus pipeline: documents that pass all stages, mixed to target weights and packed into sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` writes a
stage's rows as Parquet in the shared folder and reads them again as the next
one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import language, mixing, ngram_join, packing, privacy
from ledgerlens.llm.common import stored, table
from ledgerlens.llm.queries import vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told (no ties); learned from the labelled rows outside the held-out fold."""
    return language.keep_identified(docs, language.learn(docs.where(~language.held_out())), ties=False)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts."""
    return ngram_join.keep_one(docs)


def remove_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced, disclosing terms generalised or removed."""
    return privacy.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents placed in sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("private_data", remove_private_data),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: A language model, MinHash classes and tokenizer ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
