"""Exact order statistics by radix selection: counts of leading bits, then only of the buckets that hold a wanted rank.

A number becomes a 64-bit key that orders as it does. Each pass counts, in all groups at once, the keys of the wanted buckets
by their next twelve bits; what is shuffled are these counts, never the values, and a group of any size is spread over all
tasks. A bucket with one distinct value ends its search, which for most data is after three or four passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuekit.operators.ranks import attach
from venuekit.session import discard, materialize

#: how far a key is shifted in each pass
SHIFTS = (52, 40, 28, 16, 4, 0)
#: rows of a table of buckets or groups that may be sent to every task
SMALL = 50_000


def ordered_key(value: Column) -> Column:
    """A number for each double, in the same order: the exponent above the 52 bits of the fraction, with the sign.

    Minus zero is zero; NaN and null have no place in the order and give null.
    """
    size = F.abs(value)
    smallest = 2.0**-1022
    guess = F.floor(F.log2(F.greatest(size, F.lit(smallest))))
    fraction = size / F.pow(F.lit(2.0), guess)
    # the logarithm of a number next to a power of two may be off by one
    exponent = guess + F.when(fraction >= 2.0, 1).when(fraction < 1.0, -1).otherwise(0)
    digits = ((size / F.pow(F.lit(2.0), exponent) - 1.0) * 2.0**52).cast("long")
    bits = (
        F.when(size == float("inf"), F.lit(2047 << 52))
        .when(size < smallest, (size / 2.0**-1022 * 2.0**52).cast("long"))
        .otherwise(F.shiftleft((exponent + 1023).cast("long"), 52) + digits)
    )
    return F.when(~F.isnan(value), F.when(value < 0, -bits).otherwise(bits))


def small(df: DataFrame) -> DataFrame:
    """A stored frame, marked for broadcast if it has few rows."""
    return F.broadcast(df) if len(df.limit(SMALL + 1).select(F.lit(1)).take(SMALL + 1)) <= SMALL else df


def keyed_values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, v, k) of the rows with a number and a group, stored once: every pass reads these columns alone."""
    v = F.col(value).cast("double") + F.lit(0.0)
    known = df.dropna(subset=[*by, value]).select(*by, v.alias("v")).where(~F.isnan("v"))
    return materialize(known.select(*by, "v", ordered_key(F.col("v")).alias("k")), "keys")


def _counted(keys: DataFrame, by: Sequence[str], shift: int) -> DataFrame:
    return keys.groupBy(*by, "top", F.shiftright("k", shift).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )


def _hits(counts: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bucket in which each wanted rank lies, and the rank inside it; at most 4,096 buckets stand in a row."""
    before = Window.partitionBy(*by, "top").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    met = wanted.join(placed, [*by, "top"]).where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
    return met.select(*by, "want", F.col("bucket").alias("top"), (F.col("rank") - F.col("before")).alias("rank"), "lo", "hi")


def select_ranks(keys: DataFrame, by: Sequence[str], ranks_of) -> DataFrame:
    """(by, n, want, v): the value at each wanted rank, from 0, of each group of ``keyed_values``.

    ``ranks_of`` gives the wanted ranks, an array, from the column ``n``, the number of values.
    """
    by = list(by)
    first = keys.withColumn("top", F.lit(0).cast("long"))
    counts = materialize(_counted(first, by, SHIFTS[0]), "buckets")
    sizes = counts.groupBy(*by, "top").agg(F.sum("n").alias("n"))
    asked = sizes.select(*by, "top", F.explode(F.array_distinct(ranks_of(F.col("n")))).alias("want"))
    hits = materialize(_hits(counts, asked.withColumn("rank", F.col("want")), by), "hits")
    passes = [hits]
    for before, shift in zip(SHIFTS, SHIFTS[1:], strict=False):
        open_ = hits.where("lo < hi")
        if open_.isEmpty():
            break
        tops = small(open_.select(*by, "top").distinct())
        inside = keys.withColumn("top", F.shiftright("k", before)).join(tops, [*by, "top"], "left_semi")
        hits = materialize(_hits(_counted(inside, by, shift), open_.drop("lo", "hi"), by), "hits")
        passes.append(hits)
    found = passes[0].where("lo = hi")
    for more in passes[1:]:
        found = found.unionByName(more.where("lo = hi"))
    found = found.select(*by, "want", F.col("lo").alias("v"))
    total = sizes.drop("top")
    result = materialize(attach(found, total, by), "ranks")
    discard(counts, *passes)
    return result


def quantiles(keys: DataFrame, probabilities: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """(by, n, one column a name): linearly interpolated quantiles of each group of ``keyed_values``."""
    by = list(by)
    place = lambda n, p: (n - 1) * F.lit(float(p))
    low = lambda n, p: F.floor(place(n, p)).cast("long")
    high = lambda n, p: F.least(low(n, p) + 1, n - 1)
    found = select_ranks(keys, by, lambda n: F.array(*[f(n, p) for p in probabilities.values() for f in (low, high)]))
    n, at = F.col("n"), lambda rank: F.max(F.when(F.col("want") == rank, F.col("v")))
    sides = found.groupBy(*by, "n").agg(
        *[x for c, p in probabilities.items() for x in (at(low(n, p)).alias(f"{c}_lo"), at(high(n, p)).alias(f"{c}_hi"))]
    )
    between = lambda c, p: F.col(f"{c}_lo") + (F.col(f"{c}_hi") - F.col(f"{c}_lo")) * (place(n, p) - low(n, p))
    # an infinite pair has no difference
    exact = lambda c, p: F.when(F.col(f"{c}_lo") == F.col(f"{c}_hi"), F.col(f"{c}_lo")).otherwise(between(c, p))
    return sides.select(*by, "n", *[exact(c, p).alias(c) for c, p in probabilities.items()])
