"""Chart inputs as small frames: histograms, density curves, box statistics and scatter extracts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.operators.radix import keyed_values, quantiles, small
from venuekit.operators.ranks import attach
from venuekit.operators.sampling import sample_rows
from venuekit.session import discard, materialize


# A value's place among the bins is rounded to this many digits of a bin: a mean that lies on an edge then falls in the
# same bin whatever order its sum was formed in, and however small the range is.
PLACE_DIGITS = 9

# Moments of a cell of the density curve, and the bandwidths beyond which a cell has no part in a grid point.
TERMS = 16
REACH = 9


def _known(df: DataFrame, column: str) -> DataFrame:
    v = F.col(column).cast("double")
    return df.select(v.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))


def _bin(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """The equal-width bin of a value, from 1; the last one is closed, and without a range there is only the first."""
    place = F.floor(F.round(F.try_divide((v - lo) * bins, hi - lo), PLACE_DIGITS)) + 1
    return F.least(F.coalesce(place, F.lit(1)), F.lit(bins)).cast("int")


def _bounds(values: DataFrame) -> DataFrame:
    """Smallest and largest value; a single value gets a range of width one around it."""
    lo, hi = F.min("v"), F.max("v")
    half = F.when(lo == hi, 0.5).otherwise(0.0)
    return values.agg((lo - half).alias("lo"), (hi + half).alias("hi"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are kept with 0."""
    values = _known(df, column)
    bounds = _bounds(values)
    counted = (
        attach(values, bounds, ())
        .groupBy(_bin(F.col("v"), F.col("lo"), F.col("hi"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    # counted has at most `bins` rows
    return attach(every.join(F.broadcast(counted), "bin", "left"), bounds, ()).select(
        "bin",
        (F.col("lo") + width * (F.col("bin") - 1)).alias("bin_start"),
        (F.col("lo") + width * F.col("bin")).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def density_curve(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian density over [min, max] on a grid, bandwidth by Scott's rule, by the fast Gauss transform.

    Values are gathered into cells one bandwidth wide with their first ``TERMS`` moments about the cell's centre, one pass
    with partial aggregation, and each grid point is evaluated from the moments of the cells within ``REACH`` bandwidths by a
    Hermite series. The cost is rows x terms + cells x points, however many distinct values there are. A kernel is off by
    less than 1e-11 of its peak: 5e-12 for the terms left out, half a cell from the centre, and 3e-18 for cells beyond reach. Without spread there is no bandwidth and the density is null.
    """
    values = _known(df, column)
    spread = values.agg(
        F.count(F.lit(1)).alias("total"),
        (F.pow(F.count(F.lit(1)), F.lit(-0.2)) * F.stddev("v")).alias("bandwidth"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
    ).withColumn("step", (F.col("hi") - F.col("lo")) / (points - 1))
    # in bandwidths from the smallest value; a cell's centre is half a bandwidth above its edge
    placed = attach(values, spread, ()).select(
        F.try_divide(F.col("v") - F.col("lo"), F.col("bandwidth")).alias("z"), F.try_divide("step", "bandwidth").alias("dz")
    ).where(F.col("z").isNotNull()).withColumn("cell", F.floor("z"))
    off = ((F.col("z") - F.col("cell") - 0.5) / math.sqrt(2)).alias("off")
    powers = [F.lit(1.0)]
    for _ in range(TERMS - 1):
        powers.append(powers[-1] * F.col("off"))
    cells = placed.select("cell", "dz", off).groupBy("cell", "dz").agg(
        F.array(*[F.sum(x) / math.factorial(k) for k, x in enumerate(powers)]).alias("moments")
    )
    centre, dz = F.col("cell") + 0.5, F.col("dz")
    near = F.sequence(
        F.greatest(F.ceil((centre - REACH) / dz), F.lit(0)).cast("int"),
        F.least(F.floor((centre + REACH) / dz), F.lit(points - 1)).cast("int"),
    )
    met = cells.select(centre.alias("centre"), "dz", "moments", F.explode(near).alias("point")).withColumn(
        "y", (F.col("point") * dz - F.col("centre")) / math.sqrt(2)
    )
    sums = met.groupBy("point").agg(F.sum(_hermite_sum(F.col("moments"), F.col("y"))).alias("kernels"))
    scale = F.col("total") * F.col("bandwidth") * math.sqrt(2 * math.pi)
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    # at most one row a grid point
    return attach(grid.join(F.broadcast(sums), "point", "left"), spread, ()).select(
        "point", (F.col("lo") + F.col("step") * F.col("point")).alias("x"),
        F.try_divide(F.coalesce("kernels", F.lit(0.0)), scale).alias("density"),
    ).where(F.col("x").isNotNull())


def _hermite_sum(moments: Column, y: Column) -> Column:
    """The sum over k of moment k times the Hermite function k at ``y``, by the recursion of these functions."""
    state = F.struct(
        F.lit(0.0).alias("before"), F.exp(-y * y).alias("here"), F.lit(0).alias("k"), F.lit(0.0).alias("sum")
    )
    step = lambda s, m: F.struct(
        s["here"].alias("before"), (2 * y * s["here"] - 2 * s["k"] * s["before"]).alias("here"), (s["k"] + 1).alias("k"),
        (s["sum"] + m * s["here"]).alias("sum"),
    )
    return F.aggregate(moments, state, step, lambda s: s["sum"])


def box_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, Tukey whiskers (furthest datum within 1.5 interquartile ranges) and outliers per group.

    Quartiles by radix selection (see ``radix``), whiskers and outliers in one pass more; the values themselves are stored
    once and never shuffled, unless there are more groups than a task can look up. The passes run before this returns.
    """
    by = list(by)
    keys = keyed_values(df, value, by)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    quartiles = materialize(
        quantiles(keys, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by).withColumns(
            {"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach}
        ),
        "quartiles",
    )
    inside = F.col("v").between(F.col("low_fence"), F.col("high_fence"))
    names = ["n", "q1", "median", "q3"]
    fenced = keys.join(small(quartiles), by) if by else attach(keys, quartiles, ())
    made = materialize(
        fenced.groupBy(*by).agg(
            *[F.max(c).alias(c) for c in names],
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        ),
        "boxes",
    )
    discard(keys, quartiles)
    return made


def scatter_points(
    df: DataFrame, key: str, columns: Sequence[str], n: int | None = None, seed: int | str = 42
) -> DataFrame:
    """The complete points for plotting: all of them, or with ``n`` at most so many."""
    points = df.select(key, *columns).dropna(subset=list(columns)[:2])
    return points if n is None else sample_rows(points, key, n, seed)


def scatter_bins(df: DataFrame, x: str, y: str, x_bins: int, y_bins: int) -> DataFrame:
    """Point counts on an equal-width grid: the scatter plot of all rows, whatever their number."""
    points = df.select(*[F.col(c).cast("double").alias(axis) for c, axis in ((x, "x"), (y, "y"))]).dropna()
    bounds = points.agg(
        F.min("x").alias("x_lo"), F.max("x").alias("x_hi"), F.min("y").alias("y_lo"), F.max("y").alias("y_hi")
    )

    def cell(axis: str, bins: int):
        return _bin(F.col(axis), F.col(f"{axis}_lo"), F.col(f"{axis}_hi"), bins).alias(f"{axis}_bin")

    return (
        attach(points, bounds, ())
        .groupBy(cell("x", x_bins), cell("y", y_bins))
        .agg(F.count(F.lit(1)).alias("n"))
    )
