"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and calls one operator of ``tidemark.llm``; its result is written as Parquet and
read again as the documents of the next one. All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import mixing, packing, pii, quality, simhash
from tidemark.llm.common import stored
from tidemark.llm.queries import LANGUAGES, SOURCES, TOPICS, topic_of


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; the number of characters follows the text."""
    redacted = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target shares of sources, languages and topics."""
    return mixing.sample(docs, topic_of(F.col("text")), SOURCES, LANGUAGES, TOPICS, share=0.5)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, with their ids, each in its place of a sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality rules", keep_good),
    ("near-duplicates", keep_one_of_near_duplicates),
    ("personal data", redact_personal_data),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]

# perplexity models, components, raking and tokenising are beyond SQL; tests hold the rows against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
