"""The corpus pipeline: documents in, packed training sequences out.

Every stage works on what the one before it kept and is written before the next reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm import exact, language, packing, quality, simhash
from quarterdeck.llm.queries import END_ID, WORD_FILE
from quarterdeck.llm.shared import scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letter, or none told with half the probability."""
    return language.keep_identified(docs, language.learn(docs))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the co-trained classifier holds for bad."""
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_accepted(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.keep_one_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    pieces = packing.pack_documents(docs, WORD_FILE, END_ID)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language_id", identify_language),
    ("quality", classify_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

# Language, quality and packing have no form in SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
