"""Documents to packed training sequences: quality rules, near-duplicates, decontamination, PII, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import leaks, lines, packing, pseudonyms, simhash, tokens
from tillroll.llm.queries import pseudonym_key
from tillroll.llm.store import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(docs, pseudonym_key(spark)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces with their ids, which are the training data, and a checksum of them."""
    pieces = packing.packed(docs, tokens.tokenizer_path("word_bpe_49k.json"), end=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packed),
]

#: Tokens, Golay keys and random walks cannot be written in SQL; tests/llm compares run() with a
#: brute-force version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written and read again before the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
