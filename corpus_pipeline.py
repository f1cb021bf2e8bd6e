"""From documents to tokens: language ID, line dedup, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuekit.llm import bpe, language, lines, mixing, order_minhash
from venuekit.session import discard, materialize


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear."""
    return language.confident_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line repeats or nearly repeats; those without any line left go."""
    return lines.dedup_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return order_minhash.near_representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the mix takes."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digest of the text that they decode to."""
    decoded = bpe.decode(bpe.encode(docs))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", keep_languages), ("line_dedup", dedup_lines), ("near_dedup", dedup_documents), ("mixing", mix_sources),
    ("bpe", encode),
]

# Character n-gram models, samples of minima and merges have no SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from documents to token ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made = materialize(stage(spark, docs, sf_dir), name)
        discard(docs)
        docs = made
    return docs
