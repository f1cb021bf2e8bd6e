"""Per-business review summaries. Each is one partially aggregated exchange on the business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuekit.functions.text import NEGATIVE, POSITIVE, sentiment, utf16_length


def review_votes(reviews: DataFrame, key: str = "business_id") -> DataFrame:
    """Mean stars and mean useful, funny and cool votes."""
    return reviews.groupBy(key).agg(
        F.avg("stars").alias("avg_review_stars"),
        *[F.avg(vote).alias(f"avg_{vote}") for vote in ("useful", "funny", "cool")],
    )


def review_averages(reviews: DataFrame, key: str = "business_id") -> DataFrame:
    """Mean stars and mean useful votes, the form the place datasets carry."""
    return reviews.groupBy(key).agg(F.avg("stars").alias("avg_stars"), F.avg("useful").alias("avg_useful"))


def review_summary(reviews: DataFrame, key: str = "business_id", count_as: str = "review_count") -> DataFrame:
    """Number of reviews and mean stars."""
    return reviews.groupBy(key).agg(
        F.count(F.lit(1)).alias(count_as), F.avg("stars").alias("avg_review_stars")
    )


def score_reviews(
    reviews: DataFrame,
    positive: Sequence[str] = POSITIVE,
    negative: Sequence[str] = NEGATIVE,
    mode: str = "substring",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per review: whole stars (truncated), sentiment and text length. The text itself is dropped before any shuffle."""
    return reviews.select(
        "business_id",
        "user_id",
        *keep,
        F.col("stars").try_cast("double").try_cast("int").alias("stars"),
        sentiment("text", positive, negative, mode).alias("sentiment"),
        utf16_length("text").alias("text_length"),
    )


def sentiment_rollup(scored: DataFrame, key: str = "business_id", approx_users: bool = False) -> DataFrame:
    """Reviews, mean stars, sentiment and length, and distinct reviewers per business.

    The exact distinct count first groups on (business, user), so one very popular business is spread over many
    tasks; ``approx_users`` keeps a fixed-size sketch instead.
    """
    users = F.approx_count_distinct("user_id") if approx_users else F.count_distinct("user_id")
    return scored.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.avg("stars").alias("avg_stars"),
        F.avg("sentiment").alias("avg_sentiment"),
        F.avg("text_length").alias("avg_text_length"),
        users.alias("unique_users"),
    )
