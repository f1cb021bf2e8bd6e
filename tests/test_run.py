"""All jobs together, from JSON lines to reports and models."""

import pytest
from pyspark.sql import functions as F

from venue_queries import QUERIES
from venue_queries import views as V
from venuekit import schema as S
from venuekit.plans.run import run_all
from venuekit.sources.geojson import read_geojson_collections, read_geojson_features
from venuekit.sources.tables import valid_records


@pytest.fixture(scope="module")
def inputs(spark, sf_dir, tmp_path_factory):
    """The bound tables as JSON lines, with a few lines that are not records."""
    base = tmp_path_factory.mktemp("inputs")
    business = V.businesses(spark, sf_dir).drop("category_array")
    business.withColumn("business_id", F.col("business_id").cast("string")).write.json(str(base / "business"))
    reviews = V.reviews(spark, sf_dir).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    reviews = reviews.withColumns({c: F.col(c).cast("string") for c in ("business_id", "user_id", "review_id")})
    reviews.withColumn("text", F.lit("good food, bad noise, love it")).write.json(str(base / "reviews"))
    spark.createDataFrame([("{broken",), ('{"business_id": "1"}',)], "value string").coalesce(1).write.mode(
        "append"
    ).text(str(base / "reviews"))
    stamps = V.checkin_stamps(spark, sf_dir)
    stamps.select(
        F.col("business_id").cast("string").alias("business_id"), F.concat_ws(", ", "t1", "t2").alias("date")
    ).write.json(str(base / "checkins"))
    return base


def test_run_all(spark, sf_dir, inputs, tmp_path):
    run = run_all(spark, str(inputs / "business"), str(inputs / "reviews"), str(inputs / "checkins"), str(tmp_path))

    def read(name):
        return spark.read.parquet(run.path(name))

    assert {(r.source, r.reason): r.n for r in read("reports/corrupt_records").collect()} == {
        ("review", "parse_error"): 1, ("review", "missing_user_id"): 1,
    }
    n_business, n_reviews = V.businesses(spark, sf_dir).count(), V.reviews(spark, sf_dir).count()
    assert valid_records(read("businesses")).count() == n_business
    assert valid_records(read("reviews")).count() == n_reviews
    assert read("reports/reviews_by_year").agg(F.sum("review_count")).first()[0] == n_reviews
    assert read("sentiment").agg(F.sum("total_reviews")).first()[0] == n_reviews
    assert read("sentiment").agg(F.min("avg_sentiment"), F.max("avg_sentiment")).first() == pytest.approx((1 / 3,) * 2)

    growth = {r.business_id: round(r.avg_growth_rate, 9) for r in read("temporal").collect()}
    direct = QUERIES["growth_by_business"](spark, sf_dir).collect()
    assert {k: round(v, 6) for k, v in growth.items()} == {str(r.business_id): r.avg_growth_rate for r in direct}

    assert read("model_data").columns == QUERIES["model_dataset"](spark, sf_dir).columns
    assert read_geojson_features(spark, run.path("geojson")).count() > 0
    assert read_geojson_collections(spark, run.path("geojson_top_states")).count() > 0
    assert spark.read.text(run.path("temporal_patterns")).filter("value like '%|hour_profile:%'").count() > 0
    assert spark.read.text(run.path("business_processed")).count() == n_business
    assert read("model_metrics/longevity_model").first().auc is not None
    assert read("model_data_transformed").filter("feature is not null").count() == 7
    assert read("reports/confusion_matrix").agg(F.sum("n")).first()[0] > 0


def test_run_accepts_the_nested_shape(spark, sf_dir, inputs, tmp_path):
    nested = V.businesses(spark, sf_dir).select(
        F.col("business_id").cast("string").alias("business_id"), "name", F.struct("city", "state").alias("location"),
        "stars", "review_count", "is_open", "latitude", "longitude", "attributes",
        F.col("category_array").alias("categories"),
    )
    nested.write.json(str(tmp_path / "nested"))
    run = run_all(
        spark, str(tmp_path / "nested"), str(inputs / "reviews"), str(inputs / "checkins"), str(tmp_path / "out"),
        business_schema=S.BUSINESS_NESTED, with_models=False,
    )
    assert spark.read.text(run.path("business_processed")).count() == nested.count()
    assert spark.read.parquet(run.path("reports/hours_coverage")).first().with_hours == 0


def test_a_stage_alone_reads_what_others_left(spark, sf_dir, inputs, tmp_path):
    paths = [str(inputs / name) for name in ("business", "reviews", "checkins")]
    out = str(tmp_path / "out")
    run = run_all(spark, *paths, out, stages=("load", "text", "datasets"))
    assert not (tmp_path / "out" / "models").exists() and not (tmp_path / "out" / "reports" / "kpis").exists()
    # the inputs are not needed any more
    run_all(spark, "none", "none", "none", out, stages=("models",))
    assert spark.read.parquet(run.path("model_metrics/longevity_model")).first().auc is not None
    with pytest.raises(ValueError, match="unknown stages"):
        run_all(spark, *paths, out, stages=("paint",))
