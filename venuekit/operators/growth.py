"""Year-over-year review growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venuekit.functions.encode import clip

# The ranges within which growth figures are charted.
GROWTH_RANGE = (-1.0, 2.0)
STAR_CHANGE_RANGE = (-1.0, 1.0)

# Wording of correlation strength, strongest first.
CORRELATION_BANDS = [
    (0.5, "strong positive"),
    (0.3, "moderate positive"),
    (0.1, "weak positive"),
    (-0.1, "none"),
]


def yearly_reviews(timed: DataFrame, key: str = "business_id", stars: str = "stars") -> DataFrame:
    """Reviews and mean stars by business and year."""
    return timed.groupBy(key, "review_year").agg(
        F.count(F.lit(1)).alias("yearly_reviews"), F.avg(stars).alias("yearly_avg_stars")
    )


def year_pairs(yearly: DataFrame, key: str = "business_id") -> DataFrame:
    """Each year next to the following one of the same business; a gap year gives no pair.

    The pairing is a window over the yearly rows (at most one per year and business) instead of a self-join, so
    the reviews are aggregated once and the window's partitioning also serves a later aggregate on the key.
    """
    ahead = Window.partitionBy(key).orderBy("review_year")
    columns = ("review_year", "yearly_reviews", "yearly_avg_stars")
    # a null business is no business: it has no following year
    known = yearly.filter(F.col(key).isNotNull() & F.col("review_year").isNotNull())
    paired = known.select(key, *columns, *[F.lead(c).over(ahead).alias(f"next_{c}") for c in columns])
    growth = F.col("next_yearly_reviews") - F.col("yearly_reviews")
    return paired.filter(
        (F.col("next_review_year") == F.col("review_year") + 1) & (F.col("yearly_reviews") > 0)
    ).select(
        key,
        F.col("review_year").alias("year1"),
        F.col("yearly_reviews").alias("reviews1"),
        F.col("next_review_year").alias("year2"),
        F.col("next_yearly_reviews").alias("reviews2"),
        growth.alias("review_growth"),
        F.try_divide(growth.cast("double"), F.col("yearly_reviews").cast("double")).alias("growth_rate"),
        F.col("yearly_avg_stars").alias("stars1"),
        F.col("next_yearly_avg_stars").alias("stars2"),
        (F.col("next_yearly_avg_stars") - F.col("yearly_avg_stars")).alias("star_change"),
    )


def extreme_growth(pairs: DataFrame, k: int = 10, top: bool = True, key: str = "business_id") -> DataFrame:
    """The ``k`` fastest (or slowest) growing year pairs; ties go by business and year."""
    by_rate = F.col("growth_rate").desc() if top else F.col("growth_rate").asc()
    return pairs.orderBy(by_rate, key, "year1").limit(k)


def growth_metrics(pairs: DataFrame, key: str = "business_id") -> DataFrame:
    """Mean growth rate and star change by business; ``years_with_data`` counts year pairs."""
    return pairs.groupBy(key).agg(
        F.avg("growth_rate").alias("avg_growth_rate"),
        F.avg("star_change").alias("avg_star_change"),
        F.count(F.lit(1)).alias("years_with_data"),
    )


def review_growth(timed: DataFrame, key: str = "business_id", stars: str = "stars") -> DataFrame:
    """Growth metrics straight from reviews with calendar parts."""
    return growth_metrics(year_pairs(yearly_reviews(timed, key, stars), key), key)


def clip_growth(metrics: DataFrame) -> DataFrame:
    """Growth figures clamped to the charted ranges."""
    return metrics.withColumns(
        {
            "avg_growth_rate": clip("avg_growth_rate", *GROWTH_RANGE),
            "avg_star_change": clip("avg_star_change", *STAR_CHANGE_RANGE),
        }
    )


def growth_rating_correlation(metrics: DataFrame) -> DataFrame:
    """Pearson correlation of clamped star change and growth over complete pairs, with its strength in words."""
    corr = clip_growth(metrics).agg(F.corr("avg_star_change", "avg_growth_rate").alias("correlation"))
    known = F.col("correlation").isNotNull() & ~F.isnan("correlation")
    band = F.when(~known, "undefined")
    for above, words in CORRELATION_BANDS:
        band = band.when(F.col("correlation") > above, words)
    return corr.select("correlation", band.otherwise("negative").alias("strength"))


def volume_trend(yearly: DataFrame, key: str = "business_id") -> DataFrame:
    """Slope of the yearly review count over the years, for businesses with at least two."""
    dated = yearly.filter(F.col("review_year").isNotNull())
    return (
        dated.groupBy(key)
        .agg(
            F.regr_slope(F.col("yearly_reviews").cast("double"), F.col("review_year").cast("double")).alias("slope"),
            F.count(F.lit(1)).alias("years"),
        )
        .filter(F.col("years") >= 2)
    )
