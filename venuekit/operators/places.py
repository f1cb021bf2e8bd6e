"""Places: directory, density and regional profiles, map extracts and GeoJSON features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.functions.encode import RATING_BANDS_4, main_category, place_label, rating_band
from venuekit.operators.sampling import sample_fraction, sample_rows
from venuekit.sinks.text import escaped

# Sizes of the top lists and of the map extracts.
TOP_STATES = 10
TOP_CITIES = 20
TOP_POSTAL = 20
MAP_FRACTION = 0.1
MAP_FEATURES = 5000
MAP_POINTS = 1000


def location_directory(business: DataFrame, categories: str = "category_array") -> DataFrame:
    """Businesses by location key ``state:city``, one row each; rows without a required field are left out.

    The listing stays in row form: a location that holds a large share of all businesses never has to fit in one
    task. ``sinks.tables.write_grouped_lines`` writes it grouped by location.
    """
    required = ["business_id", "name", "stars", "review_count", "city", "state"]
    return business.dropna(subset=required).select(
        F.concat_ws(":", "state", "city").alias("location"),
        "business_id",
        "name",
        main_category(F.col(categories)).alias("main_category"),
        "stars",
        "review_count",
    )


def directory_line(directory: DataFrame) -> DataFrame:
    """Directory rows as text: location and ``id|name|category|stars|reviews``; signs that would break a field are escaped."""
    fields = ["business_id", "name", "main_category", "stars", "review_count"]
    return directory.select(
        escaped(F.col("location")).alias("location"), "business_id",
        F.concat_ws("|", *[escaped(F.col(c).cast("string")) for c in fields]).alias("line"),
    )


def top_counts(df: DataFrame, *keys: str, k: int | None = None, keep_null: bool = True) -> DataFrame:
    """Rows by key, most first; ties go by key. Charts leave rows with a null key out (``keep_null=False``)."""
    known = df if keep_null else df.dropna(subset=list(keys))
    counted = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("business_count"))
    ordered = counted.orderBy(F.col("business_count").desc(), *keys)
    return ordered if k is None else ordered.limit(k)


def postal_density(geo: DataFrame, k: int = TOP_POSTAL) -> DataFrame:
    """The ``k`` densest postal codes with their mean ratings and review counts."""
    keys = ["postal_code", "city", "state"]
    return (
        geo.groupBy(*keys)
        .agg(
            F.count("business_id").alias("business_count"),
            F.avg("stars").alias("avg_business_stars"),
            F.avg("avg_stars").alias("avg_review_stars"),
            F.avg("review_count").alias("avg_review_count"),
        )
        .orderBy(F.col("business_count").desc(), *keys)
        .limit(k)
    )


def state_profile(geo: DataFrame) -> DataFrame:
    """Count, mean, spread and median of ratings by state."""
    return geo.groupBy("state").agg(
        F.count("business_id").alias("business_count"),
        F.avg("stars").alias("avg_business_stars"),
        F.stddev("stars").alias("stddev_stars"),
        F.avg("avg_stars").alias("avg_review_stars"),
        F.avg("review_count").alias("avg_review_count"),
        F.percentile_approx("stars", 0.5).alias("median_stars"),
    )


def top_state_places(geo: DataFrame, k: int = TOP_STATES) -> DataFrame:
    """All places of the ``k`` states with most places."""
    top = top_counts(geo.filter(F.col("state").isNotNull()), "state", k=k).select("state")
    # at most k rows
    return geo.join(F.broadcast(top), "state", "left_semi")


def density_sentiment(geo: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Business density next to review sentiment, by postal code."""
    scored = geo.join(sentiment.select("business_id", "total_reviews", "avg_sentiment"), "business_id", "left")
    return scored.groupBy("postal_code", "city", "state").agg(
        F.count("business_id").alias("business_count"),
        F.sum("total_reviews").alias("scored_reviews"),
        F.try_divide(
            F.sum(F.col("avg_sentiment") * F.col("total_reviews")), F.sum("total_reviews").cast("double")
        ).alias("avg_sentiment"),
    )


def category_profile(business: DataFrame, sentiment: DataFrame, categories: str = "category_array") -> DataFrame:
    """Count, mean stars, success rate and mean sentiment by category; a business counts in each of its own."""
    scored = business.join(sentiment.select("business_id", "avg_sentiment"), "business_id", "left")
    return (
        scored.select(F.explode(categories).alias("category"), "stars", "success", "avg_sentiment")
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("business_count"),
            F.avg("stars").alias("avg_stars"),
            F.avg("success").alias("success_rate"),
            F.avg("avg_sentiment").alias("avg_sentiment"),
        )
    )


def _number(c: str) -> Column:
    return F.col(c).cast("double")


def has_coordinates(drop_zero: bool = False) -> Column:
    """Both coordinates present; with ``drop_zero`` a coordinate of 0 counts as missing."""
    keep = F.lit(True)
    for c in ("latitude", "longitude"):
        keep = keep & F.col(c).isNotNull() & ~F.isnan(_number(c))
        if drop_zero:
            keep = keep & (_number(c) != 0.0)
    return keep


def map_sample(
    places: DataFrame, key: str = "business_id", seed: int | str = 42, fraction: float = MAP_FRACTION,
    features: int | None = MAP_FEATURES,
) -> DataFrame:
    """The map extract: a share of the places, at most ``features``."""
    return sample_fraction(places, key, fraction, seed, features)


def plotted_points(
    places: DataFrame, key: str = "business_id", seed: int | str = 42, points: int = MAP_POINTS
) -> DataFrame:
    """The places the dashboard map shows: ``points`` of them, or all, if fewer."""
    return sample_rows(places, key, points, seed)


def map_points(places: DataFrame, key: str = "business_id", bands=None, seed: int | str = 42) -> DataFrame:
    """Plotted points with coordinates, marker colour and label."""
    return (
        plotted_points(places, key, seed)
        .filter(has_coordinates())
        .select(
            key, "latitude", "longitude",
            rating_band("stars", bands or RATING_BANDS_4).alias("color"), place_label().alias("label"),
        )
    )


def map_centroid(points: DataFrame) -> DataFrame:
    """Mean position, where the map is centred."""
    return points.agg(F.avg("latitude").alias("center_lat"), F.avg("longitude").alias("center_lon"))


def geojson_features(places: DataFrame, drop_zero: bool = True) -> DataFrame:
    """One GeoJSON point feature per place, as struct column ``feature``; empty categories are left out."""
    properties = F.struct(
        "name",
        "business_id",
        _number("stars").alias("stars"),
        "city",
        "state",
        F.col("review_count").cast("long").alias("review_count"),
        F.col("is_open").cast("long").alias("is_open"),
        F.when(F.col("categories") != "", F.col("categories")).alias("categories"),
    )
    geometry = F.struct(
        F.lit("Point").alias("type"), F.array(_number("longitude"), _number("latitude")).alias("coordinates")
    )
    feature = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties"))
    return places.filter(has_coordinates(drop_zero)).select("business_id", feature.alias("feature"))


def geojson_lines(features: DataFrame) -> DataFrame:
    """Features as text, one per line."""
    return features.select("business_id", F.to_json("feature").alias("value"))


def geojson_collection(
    places: DataFrame, seed: int | str = 42, fraction: float = MAP_FRACTION, features: int = MAP_FEATURES
) -> DataFrame:
    """A FeatureCollection in one cell, over the map extract only: at most ``features`` of them, as they share one cell."""
    features = geojson_features(map_sample(places, seed=seed, fraction=fraction, features=features))
    collection = F.struct(
        F.lit("FeatureCollection").alias("type"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("business_id", "feature"))), lambda x: x["feature"]
        ).alias("features"),
    )
    return features.agg(F.to_json(collection).alias("geojson"))
