"""The corpus from raw documents to packed sequences, stage by stage."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from geolayers.llm.dart_minhash import without_near_copies
from geolayers.llm.host_rules import kept_documents
from geolayers.llm.language_id import fold, kept_languages, learn_dictionaries
from geolayers.llm.packing import pack_documents
from geolayers.llm.queries import END, WORD_BPE
from geolayers.session import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, from hosts that pass."""
    return kept_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; dictionaries come from the labelled ones."""
    return kept_languages(docs, learn_dictionaries(docs.filter(fold("doc_id") != 2)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return without_near_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their token ids."""
    return pack_documents(docs, public_tokenizers.path(WORD_BPE), END)


STAGES = [("quality rules", quality), ("language ID", language), ("near-dedup", near_dedup), ("packing", packing)]

# The tokenizer, the compression and the signatures are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
