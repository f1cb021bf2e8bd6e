"""Success factors: headline figures, success rates by level, and attribute correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuekit.functions.encode import success_label

# Fixed value: a state needs more than this many businesses to be ranked by rating.
MIN_STATE_BUSINESSES = 50


def kpis(business: DataFrame) -> DataFrame:
    """Businesses, mean rating, percentage open (unknown counts as not open) and percentage successful."""
    is_open = F.coalesce((F.col("is_open") == 1).cast("double"), F.lit(0.0))
    return business.agg(
        F.count(F.lit(1)).alias("businesses"),
        F.avg("stars").alias("avg_rating"),
        (F.avg(is_open) * 100.0).alias("open_pct"),
        (F.avg("success") * 100.0).alias("success_pct"),
    )


def reviews_by_star(business: DataFrame) -> DataFrame:
    """Mean number of reviews by star level; unrated places are left out."""
    return business.filter(F.col("stars").isNotNull()).groupBy("stars").agg(F.avg("review_count").alias("avg_review_count"))


def success_by_star(business: DataFrame) -> DataFrame:
    """Percentage successful by star level; unrated places are left out."""
    return business.filter(F.col("stars").isNotNull()).groupBy("stars").agg((F.avg("success") * 100.0).alias("success_pct"))


def success_by(business: DataFrame, level: str) -> DataFrame:
    """Success rate and number of businesses by the level of an attribute; unknown levels are left out."""
    return (
        business.filter(F.col(level).isNotNull() & ~F.isnan(F.col(level).cast("double")))
        .groupBy(level)
        .agg(F.avg("success").alias("success_rate"), F.count(F.lit(1)).alias("n"))
    )


def success_counts(business: DataFrame) -> DataFrame:
    """Number of successful and unsuccessful businesses."""
    return (
        business.select(success_label("success").alias("category"))
        .filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def state_ratings(places: DataFrame, more_than: int | None = None, k: int | None = None) -> DataFrame:
    """States by mean rating, best first; optionally only those with more than so many businesses."""
    rated = (
        places.filter(F.col("state").isNotNull())
        .groupBy("state")
        .agg(F.avg("stars").alias("avg_stars"), F.count(F.lit(1)).alias("business_count"))
    )
    if more_than is not None:
        rated = rated.filter(F.col("business_count") > more_than)
    # rounded, so that equal means reached by different summation orders tie and go by name
    ordered = rated.orderBy(F.round("avg_stars", 9).desc_nulls_last(), "state")
    return ordered if k is None else ordered.limit(k)


def state_success(places: DataFrame, k: int = 10) -> DataFrame:
    """Businesses, mean stars and success rate of the ``k`` states with most businesses."""
    return (
        places.filter(F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            F.count("business_id").alias("business_count"),
            F.avg("stars").alias("avg_stars"),
            F.avg("success").alias("success_rate"),
        )
        .orderBy(F.col("business_count").desc(), "state")
        .limit(k)
    )


def attribute_correlations(df: DataFrame, features: Sequence[str], target: str = "stars") -> DataFrame:
    """Pearson correlation of each feature with the target, all in one pass."""
    one_row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("feature"),
                    F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias("correlation"),
                )
                for f in features
            ]
        ).alias("all")
    )
    return one_row.select(F.inline("all"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per column, one row each, in one pass."""
    stats = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev(c).alias("stddev"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*stats).alias("all")).select(F.inline("all"))
