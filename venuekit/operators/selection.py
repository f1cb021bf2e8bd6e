"""The n smallest digests, whatever n is: counts of leading digits, then only of the bucket that holds the border.

Each pass counts rows by three more hex digits of the digest, at most 4,096 numbers, and follows the bucket in which the
wanted rank lies. Rows are neither sorted nor shuffled, and 10^10 of them take four passes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.functions.hashing import key_digest
from venuekit.session import discard, materialize

STEP = 3
#: of rows that are equal in all columns, so many are made by one task
CHUNK = 1 << 20


@dataclass(frozen=True)
class Border:
    """Digests below ``prefix`` are in; of the ``held`` rows that begin with it, ``taken`` are."""

    prefix: str
    taken: int
    held: int


def row_digest(df: DataFrame, key: str, seed: int | str = 42) -> Column:
    """Hex digits by the key's digest; rows with one key go by a hash of all their columns."""
    rest = F.lpad(F.lower(F.hex(F.xxhash64(*df.columns))), 16, "0")
    return F.concat(key_digest(key, seed), rest)


def find_border(digests: DataFrame, share: float | None = None, n: int | None = None) -> Border | None:
    """Where the ``n`` smallest of the column ``digest`` end, or the ``floor(share * rows)`` smallest; None takes no row."""
    prefix, need = "", n
    while True:
        digit = F.substring("digest", len(prefix) + 1, STEP)
        within = digests.where(F.col("digest").startswith(prefix)) if prefix else digests
        buckets = sorted(within.groupBy(digit.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect())
        if not prefix:
            total = sum(b.n for b in buckets)
            need = math.floor(share * total) if share is not None else min(n or 0, total)
            if need <= 0:
                return None
        for bucket in buckets:
            if need <= bucket.n:
                break
            need -= bucket.n
        prefix += bucket["at"]
        if need == bucket.n or len(bucket["at"]) < STEP:
            return Border(prefix, need, bucket.n)


def flag_smallest(
    df: DataFrame, key: str, share: float | None = None, n: int | None = None, seed: int | str = 42, column: str = "is_chosen"
) -> DataFrame:
    """``df`` with a flag on exactly ``n`` rows, or on ``floor(share * rows)``: those with the smallest digest of their key.

    The same rows under any partitioning. Of rows that are equal in every column it does not matter which are taken, and
    so many are. The counts are taken from a stored copy of the digests, before this returns.
    """
    digests = materialize(df.select(row_digest(df, key, seed).alias("digest")), "digests")
    border = find_border(digests, share, n)
    discard(digests)
    if border is None:
        return df.withColumn(column, F.lit(False))
    start = F.substring(row_digest(df, key, seed), 1, len(border.prefix))
    if border.taken == border.held:
        return df.withColumn(column, start <= border.prefix)
    # only rows that are equal in every column are left at the border
    clear = df.where(start != border.prefix).withColumn(column, start < border.prefix)
    equal = df.where(start == border.prefix).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    parts = equal.withColumn("_part", F.explode(F.expr(f"sequence(0, (_n - 1) div {CHUNK})")))
    first = F.col("_part") * CHUNK + 1
    again = parts.repartition("_part").withColumn(
        "_at", F.explode(F.sequence(first, F.least(first + CHUNK - 1, F.col("_n"))))
    )
    return clear.unionByName(again.withColumn(column, F.col("_at") <= border.taken).select(*df.columns, column))


def sample_exactly(
    df: DataFrame, key: str, share: float | None = None, n: int | None = None, seed: int | str = 42
) -> DataFrame:
    """Exactly ``n`` rows or ``floor(share * rows)``, for an n that grows with the data."""
    return flag_smallest(df, key, share, n, seed, "_in").where("_in").drop("_in")
