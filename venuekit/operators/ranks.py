"""Running totals and ranks over ordered values, without sorting a group in one task.

Rows are first reduced to one per distinct value and group. The value axis is then cut into ranges of about equally
many such rows, the same cuts for all groups. Each (group, range) is summed and sorted on its own, and a row's running
total is the total of the group's ranges before it plus the running total inside its range. No task thus handles more
than about one ``ranges``-th of the rows, however large a group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuekit.session import materialize

# Ranges follow the session's shuffle width between these bounds: more would only lengthen the search expression.
FEWEST_RANGES = 64
MOST_RANGES = 1024


def range_count(spark: SparkSession) -> int:
    """As many ranges as a shuffle has partitions, so that sorting spreads as widely as the cluster does."""
    return max(FEWEST_RANGES, min(MOST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def attach(df: DataFrame, summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add ``summary``'s columns: joined on ``by``, or, for a one-row summary without keys, as a scalar subquery."""
    if by:
        return df.join(summary, list(by))
    packed = summary.select(F.struct(*summary.columns).alias("s")).scalar()
    return df.withColumn("_s", packed).select(*df.columns, *[F.col(f"_s.{c}").alias(c) for c in summary.columns])


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value (and group), as ``v`` and ``n``. Null and NaN values and null groups are left out."""
    v = F.col(value).cast("double")
    known = v.isNotNull() & ~F.isnan(v)
    for c in by:
        known = known & F.col(c).isNotNull()
    # -0.0 and 0.0 are one value
    return df.filter(known).groupBy(*by, (v + F.lit(0.0)).alias("v")).agg(F.count(F.lit(1)).alias("n"))


def _position(first: int, last: int) -> str:
    """SQL for the number of sorted ``_cuts`` below ``v``: a search tree, so that generated code makes log2(ranges)
    comparisons per row."""
    if first == last:
        return str(first)
    middle = (first + last) // 2
    return f"if(_cuts[{middle}] < v, {_position(middle + 1, last)}, {_position(first, middle)})"


def _ranged(freq: DataFrame, weights: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Add each value's range number.

    The cuts are taken together with the weights' totals, so that their plan reads the same columns as the main one
    and both share one shuffle of ``freq``.
    """
    ranges = ranges or range_count(freq.sparkSession)
    probabilities = [i / ranges for i in range(1, ranges)]
    cuts = freq.agg(
        F.percentile_approx("v", probabilities, 16 * ranges).alias("_cuts"), *[F.sum(w).alias(f"_sum_{w}") for w in weights]
    )
    number = F.expr(_position(0, ranges - 1))
    return attach(freq, cuts, ()).withColumn("_range", number).select(*freq.columns, "_range")


def _range_totals(ranged: DataFrame, weights: Sequence[str], by: list[str]) -> DataFrame:
    """Per group and range, for each weight: the total of the ranges before (``_upto_``), the range's own
    (``_here_``) and the group's (``all_``)."""
    sums = ranged.groupBy(*by, "_range").agg(*[F.sum(w).alias(f"_here_{w}") for w in weights])
    # at most one row per range and group
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        *by,
        "_range",
        *[F.col(f"_here_{w}") for w in weights],
        *[F.coalesce(F.sum(f"_here_{w}").over(earlier), F.lit(0)).alias(f"_upto_{w}") for w in weights],
        *[F.sum(f"_here_{w}").over(group).alias(f"all_{w}") for w in weights],
    )


def _inside(placed: DataFrame, weights: Sequence[str], by: list[str]) -> DataFrame:
    """Running totals inside each range, on top of the ranges before it."""
    smaller = Window.partitionBy(*by, "_range").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        *by,
        "v",
        *weights,
        *[
            (F.col(f"_upto_{w}") + F.coalesce(F.sum(w).over(smaller), F.lit(0))).alias(f"before_{w}")
            for w in weights
        ],
        *[f"all_{w}" for w in weights],
    )


def running_totals(
    freq: DataFrame, weights: Sequence[str], by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Add ``before_<w>`` (total of smaller values) and ``all_<w>`` (group total) for each whole-number weight.

    ``freq`` holds one row per group and ``v``.
    """
    by = list(by)
    ranged = _ranged(freq, weights, ranges)
    return _inside(ranged.join(_range_totals(ranged, weights, by), [*by, "_range"]), weights, by)


def ranked(df: DataFrame, order: Sequence[Column | str], column: str = "rank") -> DataFrame:
    """Each row's place, from 0, in the order given, which must be total.

    Rows are dealt to ranges of the order, stored, and numbered inside each range on top of the ranges before it; no task
    sees more than about one range. The ranges, as many as a shuffle has partitions, are counted before this returns.
    """
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(df.repartitionByRange(width, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before, total = {}, 0
    for row in sorted(placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()):
        before[row["_range"]], total = total, total + row.n
    start = F.get(F.lit([before.get(i, 0) for i in range(max(before, default=0) + 1)]), F.col("_range"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return placed.withColumn(column, (start + inside - 1).cast("long")).drop("_range")
