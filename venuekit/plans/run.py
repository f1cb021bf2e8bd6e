"""All jobs in one application, in dependency order, from JSON lines to datasets, reports and models.

The review file is parsed once: text is reduced to its score and length on the way, and everything later reads the
narrow, year-partitioned table that results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from venuekit import schema as S
from venuekit.functions.encode import open_label, success_label
from venuekit.functions.text import sentiment, utf16_length
from venuekit.operators import activity as A
from venuekit.operators import distribution as X
from venuekit.operators import growth as G
from venuekit.operators import hours as H
from venuekit.operators import metrics as E
from venuekit.operators import places as P
from venuekit.operators import reviews as R
from venuekit.operators import success as U
from venuekit.plans import datasets as D
from venuekit.plans import models as M
from venuekit.sinks import tables as K
from venuekit.sinks.text import sentiment_line
from venuekit.sources.tables import (
    REASON,
    corrupt_counts,
    read_checked,
    read_or_build,
    valid_records,
)

# Reports are small and independent: a few are written at a time, so that executors do not idle between them.
CONCURRENT_WRITES = 8

REQUIRED_REVIEW = ["business_id", "user_id", "stars", "text"]
REQUIRED_BUSINESS = ["business_id", "name", "stars", "review_count"]


@dataclass(frozen=True)
class Run:
    """Where everything is written."""

    out: str

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"


def _store(run: Run, name: str, df: DataFrame, **options) -> DataFrame:
    """Write a dataset and continue from the written copy."""
    K.write_table(df, run.path(name), **options)
    return df.sparkSession.read.parquet(run.path(name))


def load_businesses(spark: SparkSession, run: Run, path: str, schema: StructType = S.BUSINESS) -> DataFrame:
    """Canonical businesses, each with the reason why it is corrupt, if it is."""
    checked = read_checked(spark, path, schema, REQUIRED_BUSINESS)
    return _store(run, "businesses", D.normalize_business(checked, keep=[REASON]))


def load_reviews(spark: SparkSession, run: Run, path: str) -> DataFrame:
    """Checked reviews without their text, with score, length and calendar parts, partitioned by year."""
    narrow = read_checked(spark, path, S.REVIEW, REQUIRED_REVIEW).select(
        "business_id", "user_id", "stars", "useful", "funny", "cool", "date",
        sentiment("text").alias("sentiment"), utf16_length("text").alias("text_length"), REASON,
    )
    K.write_timed_reviews(A.review_times(narrow), run.path("reviews"))
    return spark.read.parquet(run.path("reviews"))


def left_out(business: DataFrame, reviews: DataFrame) -> DataFrame:
    """Good records that one job cannot use: no place for the directory, no readable date for the profiles."""
    place = F.when(F.col("city").isNull(), "missing_city").when(F.col("state").isNull(), "missing_state")
    date = F.when(F.col("date").isNotNull() & F.col("review_year").isNull(), "bad_date")
    return corrupt_counts(business.select(place.alias(REASON))).select(
        F.lit("directory").alias("source"), "reason", "n"
    ).unionByName(
        corrupt_counts(reviews.select(date.alias(REASON))).select(F.lit("profile").alias("source"), "reason", "n")
    )


def corrupt_report(run: Run, unused: DataFrame, **checked: DataFrame) -> None:
    """Corrupt records by source and reason, and good ones that a single job leaves out."""
    counts = [corrupt_counts(df).select(F.lit(name).alias("source"), "reason", "n") for name, df in checked.items()]
    K.write_table(reduce(DataFrame.unionByName, [*counts, unused]), run.path("reports/corrupt_records"))


def text_jobs(run: Run, business: DataFrame, reviews: DataFrame, checkins: DataFrame) -> DataFrame:
    """Directory by location, sentiment by business and weekly profiles, also as text rows. Returns the sentiment."""
    directory = P.directory_line(P.location_directory(business))
    K.write_grouped_lines(directory, run.path("business_processed"), "location", "business_id")
    whole = reviews.withColumn("stars", F.col("stars").try_cast("int"))
    scored = _store(run, "sentiment", R.sentiment_rollup(whole))
    K.write_grouped_lines(sentiment_line(scored), run.path("review_sentiment"), "business_id", "line")
    profile = A.temporal_profile(A.activity_from(reviews, checkins), weight="weight")
    K.write_grouped_lines(A.profile_line(profile), run.path("temporal_patterns"), "business_id", "line")
    return scored


def reports(
    run: Run, business: DataFrame, analysis: DataFrame, geo: DataFrame, growth: DataFrame, calendar: DataFrame,
    checkins: DataFrame, scored: DataFrame, reviews: DataFrame,
) -> None:
    """Every chart and table as a small dataset."""
    clipped = G.clip_growth(growth)
    places = D.chart_frame(analysis, geo, ["state"])
    labelled = analysis.withColumns({"status": open_label("is_open"), "category": success_label("success")})
    logged = analysis.select(F.log1p("review_count").alias("log_review_count"))
    tables = {
        "kpis": U.kpis(analysis),
        "reviews_by_year": A.rollup_calendar(calendar, "review_year"),
        "reviews_by_year_month": A.rollup_calendar(calendar, "review_year", "review_month"),
        "reviews_by_month": A.rollup_calendar(calendar, "review_month"),
        "reviews_by_weekday": A.name_weekdays(A.rollup_calendar(calendar, "review_day")),
        "reviews_by_hour": A.rollup_calendar(calendar, "review_hour"),
        "checkins_by_weekday": A.checkins_by_weekday(checkins),
        "hours_coverage": H.hours_coverage(business),
        "open_by_weekday": H.open_by_weekday(business),
        "rating_by_days_open": H.rating_by_days_open(business),
        "count_by_state": P.top_counts(business, "state", k=P.TOP_STATES),
        "count_by_city": P.top_counts(business, "city", "state", k=P.TOP_CITIES),
        "postal_density": P.postal_density(geo),
        "state_profile": P.state_profile(geo),
        "state_success": U.state_success(places),
        "state_ratings": U.state_ratings(geo, U.MIN_STATE_BUSINESSES, 10),
        "density_sentiment": P.density_sentiment(geo, scored),
        "reviews_by_star": U.reviews_by_star(analysis),
        "success_by_star": U.success_by_star(analysis),
        "success_by_price": U.success_by(analysis, "price_level"),
        "success_by_noise": U.success_by(analysis, "noise_level"),
        "success_by_years": U.success_by(D.chart_frame(analysis, growth, ["years_with_data"]), "years_with_data"),
        "success_counts": U.success_counts(analysis),
        "attribute_correlations": U.attribute_correlations(analysis, M.ANALYSIS_FEATURES),
        "growth_rating_correlation": G.growth_rating_correlation(growth),
        "hist_stars": X.histogram(analysis, "stars", 9),
        "hist_log_reviews": X.histogram(logged, "log_review_count", 30),
        "hist_growth": X.histogram(clipped, "avg_growth_rate", 30),
        "hist_star_change": X.histogram(clipped, "avg_star_change", 30),
        "density_stars": X.density_curve(analysis, "stars"),
        "box_stars_status": X.box_stats(labelled, "stars", ["status"]),
        "box_reviews_success": X.box_stats(labelled, "review_count", ["category"]),
        "describe": U.describe(analysis, M.ANALYSIS_FEATURES),
        "density_growth": X.density_curve(clipped, "avg_growth_rate"),
        "density_star_change": X.density_curve(clipped, "avg_star_change"),
        "scatter_growth": X.scatter_points(clipped, "business_id", ["avg_star_change", "avg_growth_rate"]),
        "scatter_reviews_stars": X.scatter_points(analysis, "business_id", ["review_count", "stars", "success"]),
        "box_stars_wifi": X.box_stats(analysis, "stars", ["has_wifi"]),
        "state_ratings_top15": U.state_ratings(geo, k=15),
        "top_states": P.top_counts(geo, "state", k=15, keep_null=False),
        "volume_trend": G.volume_trend(G.yearly_reviews(reviews)),
        "map_points": P.map_points(geo),
        "map_centroid": P.map_centroid(P.plotted_points(geo)),
    }
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        jobs = [pool.submit(K.write_table, table, run.path(f"reports/{name}")) for name, table in tables.items()]
    for job in jobs:
        job.result()


def fit_models(run: Run, analysis: DataFrame, model_data: DataFrame) -> dict[str, M.Fit]:
    """Fit, evaluate and save every model."""
    fits = {
        "linear_stars": M.linear_stars(analysis),
        "forest_success": M.forest_success(analysis),
        "star_rating_model": M.forest_stars(model_data),
        "success_classifier_model": M.forest_success_wide(model_data),
        "longevity_model": M.logistic_open(model_data),
        "dashboard_model": M.holdout_forest(model_data),
    }
    for name, fit in fits.items():
        K.save_model(fit.model, run.path(f"models/{name}"))
        K.write_table(fit.metrics, run.path(f"model_metrics/{name}"))
        K.write_table(fit.ranking, run.path(f"model_features/{name}"))
    held_out = fits["dashboard_model"]
    rows = M.model_rows(held_out.ranking, held_out.predictions)
    K.write_table(rows, run.path("model_data_transformed"))
    K.write_table(E.confusion_matrix(held_out.predictions), run.path("reports/confusion_matrix"))
    K.write_table(E.class_report(held_out.predictions), run.path("reports/class_report"))
    return fits


STAGES = ("load", "text", "datasets", "reports", "models")


def run_all(
    spark: SparkSession, business_path: str, review_path: str, checkin_path: str, out: str,
    business_schema: StructType = S.BUSINESS, checkin_schema: StructType = S.CHECKIN_LIST, with_models: bool = True,
    stages: Iterable[str] = STAGES,
) -> Run:
    """The named stages, from the three input files to ``out``.

    A stage builds and writes its own datasets. What it needs from a stage that is not named is read from ``out``, or
    built first if it is not there.
    """
    run, wanted = Run(out), set(stages) - (set() if with_models else {"models"})
    if wanted - set(STAGES):
        raise ValueError(f"unknown stages: {sorted(wanted - set(STAGES))}")
    ready: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name not in ready:
            stage, build = datasets[name]
            if stage in wanted:
                ready[name] = build()
            else:
                ready[name] = read_or_build(lambda: spark.read.parquet(run.path(name)), build)
        return ready[name]

    def stored(name: str, build: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        return lambda: _store(run, name, build())

    times = next(c for c in ("time", "date") if c in checkin_schema.names)
    business, reviews = (lambda: valid_records(get("businesses"))), (lambda: valid_records(get("reviews")))
    datasets = {
        "businesses": ("load", lambda: load_businesses(spark, run, business_path, business_schema)),
        "reviews": ("load", lambda: load_reviews(spark, run, review_path)),
        "checkin_records": ("load", stored(
            "checkin_records", lambda: read_checked(spark, checkin_path, checkin_schema, ["business_id", times]))),
        "checkins": ("load", stored("checkins", lambda: A.expand_checkins(valid_records(get("checkin_records"))))),
        "sentiment": ("text", lambda: text_jobs(run, business(), reviews(), get("checkins"))),
        "business_analysis": ("datasets", stored(
            "business_analysis", lambda: D.analysis_from(business(), reviews(), get("sentiment")))),
        "geographic": ("datasets", stored(
            "geographic", lambda: D.geo_dataset(business(), R.review_averages(reviews())))),
        "calendar": ("datasets", stored("calendar", lambda: A.calendar_counts(reviews()))),
        "growth_pairs": ("datasets", stored("growth_pairs", lambda: G.year_pairs(G.yearly_reviews(reviews())))),
        "temporal": ("datasets", stored("temporal", lambda: G.growth_metrics(get("growth_pairs")))),
        "model_data": ("datasets", stored("model_data", lambda: D.model_dataset(
            get("business_analysis"), get("geographic"), get("temporal").select(*S.TEMPORAL.names)))),
    }
    for name, (stage, _) in datasets.items():
        if stage in wanted:
            get(name)
    if "load" in wanted:
        corrupt_report(
            run, left_out(business(), reviews()), business=get("businesses"), review=get("reviews"),
            checkin=get("checkin_records"),
        )
    if "datasets" in wanted:
        K.write_geojson(get("geographic"), run.path("geojson"), "features")
        K.write_geojson(P.top_state_places(get("geographic")), run.path("geojson_top_states"), "collection")
    if "reports" in wanted:
        for name, top in (("growth_top10", True), ("growth_bottom10", False)):
            K.write_table(G.extreme_growth(get("growth_pairs"), top=top), run.path(f"reports/{name}"))
        reports(
            run, business(), get("business_analysis"), get("geographic"), get("temporal"), get("calendar"),
            get("checkins"), get("sentiment"), reviews(),
        )
    if "models" in wanted:
        fit_models(run, get("business_analysis"), get("model_data"))
    return run
