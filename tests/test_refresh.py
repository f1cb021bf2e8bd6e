"""Summaries refreshed by year, and tables stored by business."""

import random

import pytest
from pyspark.sql import functions as F

from venuekit.operators import growth as G
from venuekit.plans import datasets as D
from venuekit.plans import refresh as RF
from venuekit.session import new_path
from venuekit.sinks.tables import write_bucketed

REVIEW = "business_id string, user_id string, stars double, useful int, funny int, cool int, review_year int"


def reviews(spark, n=400, seed=1, years=(2018, 2019, 2020, None)):
    rng = random.Random(seed)
    rows = [
        ("hot" if i % 3 == 0 else f"b{rng.randrange(20)}", f"u{rng.randrange(50)}", rng.choice([None, 1.0, 4.5]), rng.randrange(4),
         rng.choice([None, 2]), i % 2, rng.choice(years)) for i in range(n)
    ]
    return spark.createDataFrame(rows, REVIEW).repartition(4)


def summary(spark, path):
    return sorted((tuple(r) for r in RF.merged(spark.read.parquet(path)).collect()), key=repr)


def rounded(rows):
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows]


def test_refreshed_states_equal_those_built_anew(spark):
    df = reviews(spark)
    path, anew = new_path(spark, "a"), new_path(spark, "b")
    RF.refresh(df.where("review_year is null or review_year < 2020"), path)
    RF.refresh(df.where("review_year is not null or stars > 2"), path, [2020, None])
    RF.refresh(df.where("review_year is not null or stars > 2"), anew)
    assert rounded(summary(spark, path)) == rounded(summary(spark, anew))
    want = df.where("review_year is not null or stars > 2").groupBy("business_id").agg(
        F.count(F.lit(1)), F.avg("stars"), F.avg("useful"), F.avg("funny"), F.avg("cool")
    ).collect()
    got = {r[0]: r[1:6] for r in summary(spark, path)}
    for r in want:
        assert got[r[0]] == pytest.approx(tuple(r[1:]))


def test_reviewers_are_estimated_over_all_years(spark):
    rows = [("b", f"u{i}", 1.0, 0, 0, 0, 2000 + i % 7) for i in range(5000)] * 2
    path = new_path(spark, "users")
    RF.refresh(spark.createDataFrame(rows, REVIEW), path)
    assert RF.merged(spark.read.parquet(path)).first().approx_users == pytest.approx(5000, rel=0.05)


def test_only_the_named_years_are_written_or_read(spark):
    df = reviews(spark)
    source, path = new_path(spark, "reviews"), new_path(spark, "states")
    df.write.partitionBy("review_year").parquet(source)
    stored = spark.read.parquet(source)
    RF.refresh(stored, path)
    before = {r[0]: r[1] for r in spark.read.parquet(path).select("review_year", F.input_file_name()).distinct().collect()}
    RF.refresh(stored, path, [2019])
    after = {r[0]: r[1] for r in spark.read.parquet(path).select("review_year", F.input_file_name()).distinct().collect()}
    assert {y for y in before if before[y] != after[y]} == {2019}
    plan = RF.yearly_states(stored.where(F.col("review_year").isin([2019])))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(review_year" in plan or "PartitionFilters: [(review_year" in plan


def test_a_year_without_reviews_goes(spark):
    df = reviews(spark)
    path = new_path(spark, "states")
    RF.refresh(df, path)
    RF.refresh(df.where("review_year <> 2018"), path, [2018])
    assert {r[0] for r in spark.read.parquet(path).select("review_year").distinct().collect()} == {2019, 2020, None}
    RF.refresh(df.where("review_year = 2020"), path)
    assert {r[0] for r in spark.read.parquet(path).select("review_year").distinct().collect()} == {2020}


def test_growth_from_states(spark):
    df = reviews(spark)
    path = new_path(spark, "states")
    RF.refresh(df, path)
    got = {tuple(r)[:2]: tuple(r)[2:] for r in RF.yearly_counts(spark.read.parquet(path)).collect()}
    want = G.yearly_reviews(df.where("review_year is not null")).collect()
    assert len(got) == len(want)
    for r in want:
        n, mean = got[(r.business_id, r.review_year)]
        assert n == r.yearly_reviews and mean == (pytest.approx(r.yearly_avg_stars) if r.yearly_avg_stars is not None else None)


def test_tables_by_business_are_read_without_an_exchange(spark):
    business = spark.createDataFrame([(f"b{i}", float(i % 5)) for i in range(20)], "business_id string, stars double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        places = write_bucketed(business, "refresh_business", "business_id", 8)
        stored = write_bucketed(reviews(spark), "refresh_review", "business_id", 8)
        votes = stored.groupBy("business_id").agg(F.avg("stars").alias("avg_review_stars"), F.avg("useful").alias("avg_useful"))
        for df in (
            D.geo_dataset(places.select("business_id", "stars", *[F.lit(None).alias(c) for c in D.LOCATION_COLUMNS if c not in ("business_id", "stars")]),
                          votes),
            places.join(votes, "business_id").join(G.review_growth(stored), "business_id", "left"),
            G.year_pairs(G.yearly_reviews(stored)),
        ):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan, plan
            assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("refresh_business", "refresh_review"):
            spark.sql(f"drop table if exists {name}")
