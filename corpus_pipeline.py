"""Corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardgrid.llm.decontaminate import drop_leaks
from wardgrid.llm.jaccard import drop_near_copies
from wardgrid.llm.mixing import mix_documents
from wardgrid.llm.shared import read_table, stored
from wardgrid.llm.toxicity import drop_toxic
from wardgrid.llm.wavelet import tokenize_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Near copies in the pipeline: word shingles of five, similarity 0.8 or more.
SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id."""
    return drop_near_copies(spark, docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus mixed to the sources' targets; a document taken twice is two rows."""
    return mix_documents(spark, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, read back from the token files."""
    return tokenize_documents(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

# SQL cannot express a trained classifier; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
