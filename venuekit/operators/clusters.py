"""Marker clusters: places rolled up by quadtree cell, so that a map of any zoom level shows all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.operators.places import has_coordinates

DEEPEST = 12


def _place(value: Column, low: float, span: float, level: int) -> Column:
    """Which of 2^level equal parts of the axis a coordinate lies in; one beyond the axis lies in its last part."""
    part = F.floor((value.cast("double") - low) / span * (1 << level))
    return F.least(F.greatest(part, F.lit(0)), F.lit((1 << level) - 1))


def _spread(part: Column) -> Column:
    """The bits of a number of up to 16 bits with a gap after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        part = part.bitwiseOR(F.shiftleft(part, shift)).bitwiseAND(F.lit(mask))
    return part


def quad_key(latitude: Column, longitude: Column, level: int = DEEPEST) -> Column:
    """The cell of a position at a level: the bits of its row and column in turn, so a cell's number without its last two
    bits is that of the cell around it."""
    column = _spread(_place(longitude, -180.0, 360.0, level).cast("long"))
    row = _spread(_place(latitude, -90.0, 180.0, level).cast("long"))
    return column.bitwiseOR(F.shiftleft(row, 1))


def map_clusters(places: DataFrame, deepest: int = DEEPEST, drop_zero: bool = False) -> DataFrame:
    """(level, cell, n, center_lat, center_lon, avg_stars, n_open) for each occupied cell of the levels 0 to ``deepest``.

    Level 0 is the whole map; each level halves both axes. Places without coordinates are left out, unrated ones count but
    have no part in the mean. Scale: places are summed by cell of the deepest level first, and the coarser levels are summed
    from these, so the cells of all levels are shuffled once and never the places; a cell that holds a third of all places is
    summed before the shuffle.
    """
    known = places.where(has_coordinates(drop_zero))
    sums = {
        "n": F.count(F.lit(1)), "lat": F.sum(F.col("latitude").cast("double")), "lon": F.sum(F.col("longitude").cast("double")),
        "stars": F.sum(F.col("stars").cast("double")), "n_rated": F.count("stars"), "n_open": F.count_if(F.col("is_open") == 1),
    }
    finest = known.groupBy(quad_key(F.col("latitude"), F.col("longitude"), deepest).alias("cell")).agg(
        *[s.alias(c) for c, s in sums.items()]
    )
    levels = finest.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(deepest))))
    above = F.expr(f"shiftright(cell, 2 * ({deepest} - level))")
    rolled = levels.groupBy("level", above.alias("cell")).agg(*[F.sum(c).alias(c) for c in sums])
    return rolled.select(
        "level", "cell", "n", (F.col("lat") / F.col("n")).alias("center_lat"), (F.col("lon") / F.col("n")).alias("center_lon"),
        F.try_divide("stars", "n_rated").alias("avg_stars"), "n_open",
    )
