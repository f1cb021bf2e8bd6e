"""The pipeline's derived datasets: normalised businesses, analysis, places and model input."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StringType

from venuekit.functions.encode import (
    category_array,
    noise_level,
    price_level,
    success_or_null,
    success_or_zero,
    true_flag,
    wifi_fraction,
    wifi_ordinal,
)
from venuekit.functions.hashing import normal_hash, unit_hash
from venuekit.operators.ranks import attach, ranked
from venuekit.operators.reviews import review_summary, review_votes
from venuekit.operators.selection import flag_smallest
from venuekit.schema import ATTRIBUTES_TYPE, BUSINESS, HOURS_TYPE
from venuekit.session import materialize
from venuekit.sources.tables import optional_column

# Defaults for missing analysis and growth figures.
ANALYSIS_DEFAULTS = {
    "price_level": 0.0, "noise_level": 2.0, "has_wifi": 0.0, "avg_useful": 0.0, "avg_funny": 0.0, "avg_cool": 0.0,
}
GROWTH_DEFAULTS = {"avg_growth_rate": 0.0, "avg_star_change": 0.0, "years_with_data": 0.0}

# Columns of the datasets.
ANALYSIS_COLUMNS = [
    "business_id", "name", "stars", "review_count", "is_open", "has_wifi", "price_level", "noise_level",
    "avg_review_stars", "avg_useful", "avg_funny", "avg_cool",
]
LOCATION_COLUMNS = [
    "business_id", "name", "stars", "review_count", "is_open", "categories", "latitude", "longitude", "city",
    "state", "postal_code",
]
MODEL_COLUMNS = ["business_id", "stars", "review_count", "is_open", "success"]
MODEL_OPTIONAL = [
    "has_wifi", "takes_credit_cards", "state_idx", "avg_growth_rate", "avg_star_change", "years_with_data",
]


def normalize_business(business: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The canonical flat form of either input shape: nested or flat place, category array or text.

    Adds ``category_array``; fields the input lacks come out null. Columns named in ``keep`` come along.
    """
    categories = optional_column(business, "categories")
    if "categories" in business.columns and isinstance(business.schema["categories"].dataType, ArrayType):
        as_array, as_text = categories, F.array_join(categories, ", ")
    else:
        as_array, as_text = category_array(categories), categories
    structs = {"attributes": ATTRIBUTES_TYPE, "hours": HOURS_TYPE}
    columns = []
    for field in BUSINESS.fields:
        if field.name == "categories":
            value = as_text
        elif field.name in structs:
            present = field.name in business.columns
            parts = [
                optional_column(business, f"{field.name}.{part}").cast("string").alias(part)
                for part in structs[field.name].names
            ]
            value = F.when(F.col(field.name).isNotNull(), F.struct(*parts)) if present else F.lit(None)
            value = value.cast(field.dataType)
        else:
            # a place field may be on either level, or on both and filled on one
            levels = [optional_column(business, path) for path in (field.name, f"location.{field.name}")]
            value = F.coalesce(*[level.try_cast(field.dataType) for level in levels])
        columns.append(value.alias(field.name))
    return business.select(*columns, as_array.alias("category_array"), *keep)


def business_features(business: DataFrame, strip_prefix: bool = False) -> DataFrame:
    """Encoded attributes and category array of normalised businesses."""
    return business.select(
        "business_id",
        "name",
        "stars",
        "review_count",
        F.col("is_open").cast("double").alias("is_open"),
        wifi_ordinal("attributes.WiFi", strip_prefix).alias("has_wifi"),
        price_level("attributes.RestaurantsPriceRange2").alias("price_level"),
        noise_level("attributes.NoiseLevel", strip_prefix).alias("noise_level"),
        true_flag("attributes.RestaurantsReservations").alias("takes_reservations"),
        "category_array",
    )


def analysis_dataset(features: DataFrame, votes: DataFrame, sentiment: DataFrame | None = None) -> DataFrame:
    """Businesses with reviews: features, review votes and the success flag (null when unrated).

    With ``sentiment`` the mean sentiment is added, 0.0 where no text was scored.
    """
    joined = features.join(votes, "business_id").select(*ANALYSIS_COLUMNS).fillna(ANALYSIS_DEFAULTS)
    joined = joined.withColumn("success", success_or_null("stars"))
    if sentiment is not None:
        joined = joined.join(sentiment.select("business_id", "avg_sentiment"), "business_id", "left").fillna(
            {"avg_sentiment": 0.0}
        )
    return joined


def analysis_from(business: DataFrame, reviews: DataFrame, sentiment: DataFrame | None = None) -> DataFrame:
    return analysis_dataset(business_features(business), review_votes(reviews), sentiment)


def geo_dataset(business: DataFrame, averages: DataFrame) -> DataFrame:
    """Place columns of businesses with reviews, with their review means."""
    return business.select(*LOCATION_COLUMNS).join(averages, "business_id")


def model_source(business: DataFrame) -> DataFrame:
    """The direct route from raw businesses to model input, with its own wifi scale."""
    return business.select(
        "business_id",
        "name",
        "stars",
        "review_count",
        F.col("is_open").cast("double").alias("is_open"),
        "categories",
        "latitude",
        "longitude",
        "city",
        "state",
        success_or_null("stars").alias("success"),
        wifi_fraction("attributes.WiFi").alias("has_wifi"),
        true_flag("attributes.BusinessAcceptsCreditCards").alias("takes_credit_cards"),
    )


def fallback_dataset(business: DataFrame, reviews: DataFrame) -> DataFrame:
    """Model source with review figures; the counted reviews are kept apart from the stated ``review_count``."""
    return model_source(business).join(review_summary(reviews, count_as="reviews_seen"), "business_id")


def state_index(df: DataFrame, column: str = "state", out: str = "state_idx") -> DataFrame:
    """(column, out): each category's place by descending frequency, ties alphabetical, from 0. Null is no category.

    The categories are counted and dealt to ranges of that order before this returns; a column of as many categories as rows
    is ranked too, with no task for all of them.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    places = ranked(counts, [F.col("_n").desc(), F.col(column)], "_place")
    return places.select(column, F.col("_place").cast("double").alias(out))


def model_dataset(
    analysis: DataFrame, geo: DataFrame | None = None, temporal: DataFrame | None = None
) -> DataFrame:
    """Final model input: all numbers as double, missing ones 0.

    ``geo`` adds the index of each business's state; businesses without one drop out. ``temporal`` adds growth.
    """
    frame = analysis
    if geo is not None:
        placed = geo.select("business_id", "state")
        indexed = placed.join(state_index(placed), "state").select("business_id", "state_idx")
        frame = frame.join(indexed, "business_id")
    if temporal is not None:
        grown = temporal.select("business_id", *GROWTH_DEFAULTS)
        frame = frame.join(grown, "business_id", "left").fillna(GROWTH_DEFAULTS)
    frame = frame.withColumn("success", success_or_zero("stars"))
    known = set(frame.columns)
    doubles = [F.col(c).cast("double").alias(c) for c in (*MODEL_COLUMNS[1:], *MODEL_OPTIONAL) if c in known]
    return frame.select("business_id", *doubles).fillna(0.0)


def numeric_complete(df: DataFrame, key: str = "business_id", keep_key: bool = False) -> DataFrame:
    """Numeric columns that are not all null, rows with no null among them.

    The input is computed once, into a stored copy of these columns, before this returns: one aggregate row over the copy tells
    which are empty, and the result reads it.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name != key]
    stored = materialize(df.select(*([key] if keep_key else []), *numeric), "numeric")
    filled = stored.agg(F.count(F.lit(1)), *[F.count(c).alias(c) for c in numeric]).first()
    used = [c for c in numeric if filled[c] > 0]
    return stored.select(*([key] if keep_key else []), *used).dropna("any", subset=used)


def flip_labels(
    df: DataFrame, key: str = "business_id", label: str = "success", fraction: float = 0.1, seed: int | str = 123
) -> DataFrame:
    """Swap the 0/1 label on about ``fraction`` of the rows, to test how robust a model is."""
    flipped = F.when(unit_hash(key, seed) < fraction, 1 - F.col(label)).otherwise(F.col(label))
    return df.withColumn(label, flipped)


def flip_labels_exactly(
    df: DataFrame, key: str = "business_id", label: str = "success", fraction: float = 0.1, seed: int | str = 123
) -> DataFrame:
    """Swap the 0/1 label on ``floor(fraction * rows)`` rows, those with the smallest digest of their key."""
    chosen = flag_smallest(df, key, share=fraction, seed=seed, column="_flip")
    flipped = F.when(F.col("_flip"), 1 - F.col(label)).otherwise(F.col(label))
    return chosen.withColumn(label, flipped).select(*df.columns)


def add_noise(
    df: DataFrame, columns: Sequence[str], key: str = "business_id", level: float = 0.1, seed: int | str = 42
) -> DataFrame:
    """Add normal noise of ``level`` times each column's range. A row's noise follows from its key alone."""
    ranges = df.agg(
        *[(F.max(F.col(c).cast("double")) - F.min(F.col(c).cast("double"))).alias(f"_w_{c}") for c in columns]
    )
    noisy = {
        c: F.col(c).cast("double") + normal_hash(key, f"{seed}/{c}") * level * F.col(f"_w_{c}") for c in columns
    }
    return attach(df, ranges, ()).withColumns(noisy).select(*df.columns)


def chart_frame(business: DataFrame, other: DataFrame | None, extra: Iterable[str]) -> DataFrame:
    """Businesses joined with the wanted columns of a second derived table; without one, the businesses alone."""
    if other is None:
        return business
    return business.join(other.select("business_id", *extra), "business_id")
