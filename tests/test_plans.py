"""Physical plans: what must and must not be in them."""

import pytest
from pyspark.sql import functions as F

from venue_queries import QUERIES
from venue_queries import views as V
from venuekit.operators import activity as A
from venuekit.operators import growth as G
from venuekit.operators import places as P
from venuekit.operators import reviews as R
from venuekit.operators import sampling as SM

# Queries whose plan is built without running a job first.
LAZY = [
    "growth_by_business", "review_growth", "growth_top10", "volume_trend", "reviews_by_year", "calendar_rollup",
    "checkin_expand", "route_activity", "temporal_profile_long", "sentiment_score", "sentiment_by_business",
    "analysis_dataset", "geo_dataset", "kpis", "attribute_corr", "state_profile", "postal_density",
    "location_directory", "geojson_rows", "hist_growth", "kde_growth", "box_stars_status", "auc", "confusion_matrix",
    "top_state_places", "category_profile", "density_sentiment", "feature_noise", "valid_records", "model_dataset",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for word in ("PythonUDF", "EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan, word


def test_growth_needs_two_exchanges(spark, sf_dir):
    plan = plan_of(G.review_growth(A.review_times(V.reviews(spark, sf_dir))))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan and "SinglePartition" not in plan


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    plan = plan_of(G.review_growth(A.review_times(V.reviews(spark, sf_dir))))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
    checks = plan_of(R.review_votes(V.reviews(spark, sf_dir)))
    assert "o_orderdate" not in checks and "o_totalprice" not in checks


def test_text_does_not_enter_the_shuffle(spark, sf_dir):
    plan = plan_of(R.sentiment_rollup(R.score_reviews(V.text_reviews(spark, sf_dir))))
    partial = plan[: plan.index("Exchange hashpartitioning")]
    assert "partial_avg" in plan and "text#" not in partial
    # the distinct count is grouped on business and user before business alone
    assert "hashpartitioning(business_id" in plan and plan.count("Exchange hashpartitioning") == 2


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(A.route_activity(V.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("business_id"), F.col("ts").alias("date"), F.col("ts").alias("time"))))
    assert "PushedFilters: [IsNotNull(user_id), IsNotNull(ts)]" in plan
    stored = V.table(spark, sf_dir, "lineitem").filter(F.col("l_quantity") > 40)
    assert "GreaterThan(l_quantity,40.0)" in plan_of(stored)


def test_top_lists_do_not_sort_everything(spark, sf_dir):
    business = V.businesses(spark, sf_dir)
    for df in (P.top_counts(business, "state", k=10), SM.sample_rows(business, "business_id", 100)):
        assert "TakeOrderedAndProject" in plan_of(df)


def test_same_rows_under_any_partitioning(spark, sf_dir):
    """Results do not depend on how the input is split."""
    reviews = V.reviews(spark, sf_dir)
    results = []
    for n in (1, 7, 64):
        part = reviews.repartition(n)
        votes = R.review_votes(part)
        results.append(sorted(tuple(round(x, 9) for x in r) for r in votes.collect()))
    assert results[0] == results[1] == results[2]


def test_values_are_not_exchanged_for_their_order(spark, sf_dir):
    """Each pass of the selection shuffles counts by bucket."""
    from venuekit.operators import radix

    lines = V.table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("grp"), "l_extendedprice")
    keys = radix.keyed_values(lines, "l_extendedprice", ["grp"])
    plan = plan_of(radix._counted(keys.withColumn("top", F.lit(0).cast("long")), ["grp"], 52))
    assert plan.count("Exchange") == 1 and "Sort" not in plan
    assert plan.index("Exchange") < plan.index("partial_count") < plan.index("Scan parquet")


def test_density_lays_out_cells_and_no_values(spark, sf_dir):
    """Rows are multiplied only after they are summed by cell."""
    plan = plan_of(QUERIES["kde_growth"](spark, sf_dir))
    assert plan.count("Generate explode") == 1
    assert plan.index("Generate explode") < plan.index("Aggregate(keys=[cell")


def test_category_ranks_use_no_single_task(spark, sf_dir):
    plan = plan_of(QUERIES["city_index"](spark, sf_dir))
    assert "SinglePartition" not in plan and "Window" in plan


def test_auc_reads_its_input_once(spark, sf_dir):
    df = QUERIES["auc"](spark, sf_dir)
    df.collect()
    assert plan_of(df).split("== Initial Plan ==")[0].count("Scan parquet") <= 1
