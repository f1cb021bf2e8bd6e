"""Samples and splits drawn by key hash: repeatable, independent of partitioning and of recomputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuekit.functions.hashing import key_digest, unit_hash


def sample_fraction(
    df: DataFrame, key: str, fraction: float, seed: int | str = 42, limit: int | None = None
) -> DataFrame:
    """Keep about ``fraction`` of the rows, and with ``limit`` at most that many (those with the smallest digest)."""
    kept = df.filter(unit_hash(key, seed) < fraction)
    return kept if limit is None else kept.orderBy(key_digest(key, seed), key).limit(limit)


def sample_rows(df: DataFrame, key: str, n: int, seed: int | str = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows."""
    return df.orderBy(key_digest(key, seed), key).limit(n)


def with_split(
    df: DataFrame, key: str, train: float, seed: int | str = 42, column: str = "is_train"
) -> DataFrame:
    """Flag each row as train or test."""
    return df.withColumn(column, unit_hash(key, seed) < train)


def split(df: DataFrame, key: str, train: float, seed: int | str = 42) -> tuple[DataFrame, DataFrame]:
    """The train and the test side."""
    in_train = unit_hash(key, seed) < train
    return df.filter(in_train), df.filter(~in_train)
