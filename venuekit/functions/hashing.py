"""Repeatable pseudo-random numbers from a key: the same row draws the same number under any partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = float(2**32)


def key_digest(key: Column | str, seed: int | str = 42) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def unit_hash(key: Column | str, seed: int | str = 42) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of the digest."""
    return F.conv(F.substring(key_digest(key, seed), 1, 8), 16, 10).cast("double") / _SPAN


def normal_hash(key: Column | str, seed: int | str = 42) -> Column:
    """Standard normal number from two uniform ones (Box-Muller)."""
    radius = F.sqrt(-2.0 * F.log(1.0 - unit_hash(key, f"{seed}/r")))
    return radius * F.cos(2.0 * math.pi * unit_hash(key, f"{seed}/a"))
