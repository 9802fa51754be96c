"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.llm import alignment, chosenpath, decontaminate, extract, jaccard, langid, mixing, neighbours, sharding, toxicity, warc, wavelet, whitening
from wardgrid.llm.shared import read_table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, read_table(spark, sf_dir, "pages"))


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_pages(read_table(spark, sf_dir, "pages"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.group_documents(spark, read_table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(spark, read_table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.tokenize_documents(spark, read_table(spark, sf_dir, "documents"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark, read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(spark, read_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, read_table(spark, sf_dir, "embeddings"))


def op13_chosenpath(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.group_documents(spark, read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_extract": op2_extract,
    "op3_langid": op3_langid,
    "op4_jaccard": op4_jaccard,
    "op5_sharding": op5_sharding,
    "op6_decontaminate": op6_decontaminate,
    "op7_wavelet": op7_wavelet,
    "op8_neighbours": op8_neighbours,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_alignment": op11_alignment,
    "op12_whitening": op12_whitening,
    "op13_chosenpath": op13_chosenpath,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": warc.ARCHIVE_SQL,
    "op10_mixing": mixing.MIX_SQL,
}
