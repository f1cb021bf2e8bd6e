"""Readers, writers, datasets and models."""

import json
import re
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from venuekit import schema as S
from venuekit.functions.encode import wifi_ordinal
from venuekit.plans import datasets as D
from venuekit.plans import models as M
from venuekit.session import SHUFFLE_CLEANUP, materialize, new_path, work_dir
from venuekit.sinks import tables as K
from venuekit.sinks.text import sentiment_line
from venuekit.sources import geojson as GJ
from venuekit.sources import tables as T

GOOD = {"business_id": "b1", "user_id": "u1", "stars": 4, "text": "good | fine", "date": "2020-01-01 00:00:00"}
LINES = [
    json.dumps(GOOD),
    json.dumps({**GOOD, "user_id": None}),
    json.dumps({k: v for k, v in GOOD.items() if k != "text"}),
    json.dumps({**GOOD, "stars": "many"}),
    json.dumps(GOOD)[:-10],
    "not json",
]
REQUIRED = ["business_id", "user_id", "stars", "text"]


def write_lines(tmp_path, lines):
    path = tmp_path / "in.json"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_checked_lines(spark, tmp_path, rows):
    checked = T.read_checked(spark, write_lines(tmp_path, LINES), S.REVIEW, REQUIRED)
    good = rows(T.valid_records(checked))
    assert len(good) == 1 and good[0]["text"] == "good | fine" and good[0]["stars"] == 4.0
    assert {r["reason"]: r["n"] for r in rows(T.corrupt_counts(checked))} == {
        "parse_error": 3, "missing_user_id": 1, "missing_text": 1,
    }


def test_nested_required_field(spark):
    lines = spark.createDataFrame(
        [('{"business_id":"b","location":{"city":"x","state":"y"}}',), ('{"business_id":"b","location":{}}',),
         ('{"business_id":"b"}',)], "value string",
    )
    checked = T.check_lines(lines, S.BUSINESS_NESTED, ["business_id", "location.state"])
    assert [r._reason for r in checked.collect()] == [None, "missing_location.state", "missing_location.state"]


def test_lenient_reader_skips_what_it_cannot_decode(spark, tmp_path):
    path = write_lines(tmp_path, LINES)
    assert T.read_lenient(spark, path, S.REVIEW).select("business_id").collect()[0][0] == "b1"
    # the word in stars is null, and the line stays
    assert len(T.read_lenient(spark, path, S.REVIEW).collect()) == 4


def test_read_or_build(spark, tmp_path):
    built = T.read_or_build(lambda: spark.read.parquet(str(tmp_path / "none")), lambda: spark.range(3))
    assert built.count() == 3
    with pytest.raises(AnalysisException):
        T.read_or_build(lambda: spark.range(1).select("missing"), lambda: spark.range(3))


def test_read_or_empty_and_candidates(spark, tmp_path):
    assert T.read_or_empty(spark, str(tmp_path / "none"), S.TEMPORAL).columns == S.TEMPORAL.names
    there = str(tmp_path / "there")
    K.write_table(spark.createDataFrame([("b", 0.1, 0.2, 3)], S.TEMPORAL), there, "json")
    found = T.first_available(spark, [str(tmp_path / "none"), there], S.TEMPORAL, "json")
    assert found.first().years_with_data == 3


def test_normalize_accepts_both_shapes(spark, rows):
    nested = spark.createDataFrame(
        [("b", "B", ("Phoenix", "AZ", "85001", 33.0, -112.0), None, None, None, 4.0, 3, 1, ("free", "2", None, None, None),
          ["Food", "Bars"], ("9:0-17:0", None, None, None, None, None, None))],
        S.BUSINESS_NESTED,
    )
    flat = spark.createDataFrame(
        [("b", "B", "Phoenix", "AZ", "4.0", "3", 1, "Food, Bars")],
        "business_id string, name string, city string, state string, stars string, review_count string, is_open int, "
        "categories string",
    )
    a, b = D.normalize_business(nested), D.normalize_business(flat)
    assert a.schema.names == b.schema.names == [*S.BUSINESS.names, "category_array"]
    wanted = ["business_id", "city", "state", "stars", "review_count", "is_open", "categories", "category_array"]
    assert rows(a.select(wanted)) == rows(b.select(wanted))
    assert a.select(wifi_ordinal("attributes.WiFi")).first()[0] == 2.0
    assert b.select(wifi_ordinal("attributes.WiFi")).first()[0] == 0.0
    assert b.first().hours is None and b.first().postal_code is None
    assert (a.first().hours.Monday, a.first().postal_code, a.first().latitude) == ("9:0-17:0", "85001", 33.0)


def test_geojson_round_trip(spark, tmp_path, rows):
    places = spark.createDataFrame(
        [("a", 'Joe "J"', 4.5, 10, 1, "Food", 33.4, -112.0, "Phoenix", "AZ"),
         ("b", "B", 3.0, 2, 0, None, 36.1, -115.0, "Vegas", "NV")],
        "business_id string, name string, stars double, review_count long, is_open long, categories string, "
        "latitude double, longitude double, city string, state string",
    )
    path = str(tmp_path / "features")
    K.write_geojson(places, path)
    back = GJ.read_geojson_features(spark, path)
    assert sorted(rows(back.select(places.columns)), key=str) == sorted(rows(places), key=str)
    line = spark.read.text(path).filter(F.col("value").contains('"B"')).first()[0]
    assert "categories" not in json.loads(line)["properties"]
    with pytest.raises(ValueError):
        K.write_geojson(places, path, "kml")


def test_collection_holds_the_map_extract(spark, tmp_path):
    places = spark.range(3000).selectExpr(
        "cast(id as string) business_id", "'n' name", "4.0 stars", "1 review_count", "1 is_open", "'x' categories",
        "33.0 latitude", "-112.0 longitude", "'c' city", "'s' state",
    )
    path = str(tmp_path / "collection")
    K.write_geojson(places, path, "collection")
    assert 200 < GJ.read_geojson_collections(spark, path).count() < 400


def test_sentiment_line(spark):
    rollup = spark.createDataFrame(
        [("b", 3, 4.0, 0.125, 10.005, 2)],
        "business_id string, total_reviews long, avg_stars double, avg_sentiment double, avg_text_length double, "
        "unique_users long",
    )
    assert sentiment_line(rollup).first().line == "3|4.00|0.13|10.01|2"


def test_grouped_lines_split_a_large_group(spark, tmp_path):
    lines = spark.range(20000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 50 as string)) as g", "id", "cast(id as string) as line"
    )
    path = str(tmp_path / "lines")
    K.write_grouped_lines(lines, path, "g", "id")
    back = spark.read.text(path).selectExpr("split(value, '\t')[0] as g", "input_file_name() as f")
    assert back.count() == 20000


def test_work_dir_is_the_checkpoint_dir(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x") != new_path(spark, "x")


def test_materialize(spark):
    df = spark.range(10).selectExpr("id", "id * 2 as twice")
    assert sorted(materialize(df).collect()) == sorted(df.collect())


def test_materialize_leaves_no_shuffle_files(spark):
    def shuffles():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return set(re.findall(r"shuffle_\d+", manager.getAllFiles().mkString(" ")))

    before = shuffles()
    stored = materialize(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 10).alias("k")).count())
    for _ in range(50):  # they go in the background
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert stored.count() == 10 and spark.conf.get(SHUFFLE_CLEANUP, None) in (None, "false")



# ---- model input and models -------------------------------------------------------------------------------------

def analysis_frame(spark, n=800):
    """Success follows from wifi and noise, with some chance."""
    return spark.range(n).selectExpr(
        "id as business_id", "'n' as name",
        "case when (id % 3 > 0) != (id % 10 = 0) then 4.5 else 2.5 end as stars",
        "id % 97 as review_count", "cast(id % 10 < 7 as double) as is_open", "cast(id % 3 as double) as has_wifi",
        "cast(id % 5 as double) as price_level", "2.0 as noise_level", "3.0 as avg_review_stars",
        "cast(id % 7 as double) as avg_useful", "0.0 as avg_funny", "0.0 as avg_cool",
    ).withColumn("success", (F.col("stars") >= 4).cast("double"))


def test_analysis_defaults(spark, rows):
    features = spark.createDataFrame(
        [("b", "B", None, 3, 1.0, None, None, None)],
        "business_id string, name string, stars double, review_count long, is_open double, has_wifi double, "
        "price_level double, noise_level double",
    )
    votes = spark.createDataFrame(
        [("b", 4.0, None, 1.0, None)],
        "business_id string, avg_review_stars double, avg_useful double, avg_funny double, avg_cool double",
    )
    got = rows(D.analysis_dataset(features, votes))[0]
    assert (got["noise_level"], got["price_level"], got["has_wifi"], got["avg_useful"]) == (2.0, 0.0, 0.0, 0.0)
    assert got["success"] is None and got["stars"] is None
    none = spark.createDataFrame([], "business_id string, avg_sentiment double")
    assert rows(D.analysis_dataset(features, votes, none))[0]["avg_sentiment"] == 0.0


def test_model_dataset(spark, rows):
    analysis = spark.createDataFrame(
        [("a", 4.5, 3, 1.0, 2.0, 0.0), ("b", None, 1, None, 1.0, 0.0), ("c", 1.0, 1, 0.0, 0.0, 0.0)],
        "business_id string, stars double, review_count long, is_open double, has_wifi double, success double",
    )
    geo = spark.createDataFrame([("a", "AZ"), ("b", "AZ"), ("c", None)], "business_id string, state string")
    temporal = spark.createDataFrame([("a", 0.5, -0.5, 2)], S.TEMPORAL)
    got = {r["business_id"]: r for r in rows(D.model_dataset(analysis, geo, temporal))}
    # c has no state and drops out
    assert set(got) == {"a", "b"}
    assert got["a"] == {
        "business_id": "a", "stars": 4.5, "review_count": 3.0, "is_open": 1.0, "success": 1.0, "has_wifi": 2.0,
        "state_idx": 0.0, "avg_growth_rate": 0.5, "avg_star_change": -0.5, "years_with_data": 2.0,
    }
    assert (got["b"]["stars"], got["b"]["success"], got["b"]["years_with_data"]) == (0.0, 0.0, 0.0)
    assert "state_idx" not in D.model_dataset(analysis).columns


def test_state_index_ties_are_alphabetical(spark):
    states = spark.createDataFrame([("NV",), ("AZ",), ("PA",), ("PA",), (None,)], "state string")
    got = D.state_index(states).collect()
    assert {r.state: r.state_idx for r in got} == {"PA": 0.0, "AZ": 1.0, "NV": 2.0}


def test_numeric_complete(spark):
    df = spark.createDataFrame([("a", 1.0, None, "x"), ("b", None, None, "y"), ("c", 3.0, None, "z")],
                               "business_id string, v double, empty double, note string")
    assert D.numeric_complete(df).columns == ["v"]
    assert D.numeric_complete(df, keep_key=True).count() == 2


def test_flipped_labels_and_noise(spark):
    df = analysis_frame(spark, 2000)
    flipped = df.select("business_id", "success").join(
        D.flip_labels(df).select("business_id", F.col("success").alias("after")), "business_id"
    )
    share = flipped.filter(F.col("success") != F.col("after")).count() / 2000
    assert 0.07 < share < 0.13
    noisy = D.add_noise(df, ["review_count", "noise_level"])
    spread = df.select("business_id", "review_count").join(
        noisy.select("business_id", F.col("review_count").alias("after"), "noise_level"), "business_id"
    ).agg(F.stddev(F.col("after") - F.col("review_count")), F.min("noise_level"), F.max("noise_level")).first()
    assert spread[0] == pytest.approx(9.6, rel=0.1)
    assert (spread[1], spread[2]) == (2.0, 2.0)


def test_assemble_null_policy(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "a double, b double")
    assert M.assemble(df, ["a", "b"], "skip").count() == 1
    with pytest.raises(Exception, match="(?i)null"):
        M.assemble(df, ["a", "b"]).collect()


def test_models_learn_a_planted_signal(spark):
    df = materialize(analysis_frame(spark))
    forest = M.forest_success(df)
    assert forest.metrics.first().auc > 0.7
    assert forest.ranking.first().feature == "has_wifi"
    linear = M.linear_stars(df)
    assert linear.ranking.first().feature == "has_wifi" and linear.metrics.first().rmse < 1.0


def test_holdout_keeps_every_row_and_hides_training_predictions(spark):
    df = materialize(analysis_frame(spark).select("business_id", "stars", "review_count", "has_wifi", "success"))
    fit = M.holdout_forest(df)
    assert fit.features == ["review_count", "has_wifi"]
    counts = fit.predictions.groupBy("is_train").agg(F.count("*").alias("n"), F.count("prediction").alias("p"))
    got = {r.is_train: (r.n, r.p) for r in counts.collect()}
    assert sum(n for n, _ in got.values()) == 800 and got[True][1] == 0 and got[False][0] == got[False][1]
    mixed = M.model_rows(fit.ranking, fit.predictions)
    assert mixed.filter("feature is not null").count() == 2 and mixed.count() == 802
    assert "stars" in M.holdout_forest(df, exclude=()).features


def test_saved_model_scores_the_same(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df = materialize(analysis_frame(spark).select("business_id", "stars", "review_count", "is_open", "success"))
    fit = M.logistic_open(df)
    (tmp_path / "file").write_text("in the way")
    path = K.save_model(fit.model, str(tmp_path / "file" / "model"), str(tmp_path / "second"))
    assert path.endswith("second")
    again = M.with_score(PipelineModel.load(path).transform(fit.predictions.select(df.columns)))
    a = {r.business_id: r.score for r in fit.predictions.collect()}
    assert a and a == {r.business_id: r.score for r in again.collect()}


ODD = [
    '{"business_id":"n1","stars":NaN}', '{"business_id":"n2","stars":-Infinity,"other":NaN}', '{"business_id":"n3","useful":NaN}',
    '{"business_id":"n4","text":"says NaN, and: Infinity}"}', '{"business_id":5,"stars":"4.5"}', '{"business_id":"123","stars":4}',
    '{"business_id":"true","text":"[1]"}', '{"business_id":{"a":1}}', '["business_id"]', '{"business_id":"x"} tail', "7", "", "{}",
    '{"business_id":"t","text":null,"useful":1.5}',
]


def test_lenient_reader_keeps_bare_nan_and_odd_values(spark, tmp_path):
    got = T.read_lenient(spark, write_lines(tmp_path, ODD), S.REVIEW).select("business_id", "stars", "text", "useful").collect()
    by = {r.business_id: r for r in got}
    assert {"n1", "n2", "n3", "n4", "123", "true", "t"} <= set(by)
    assert by["n1"].stars != by["n1"].stars and by["n2"].stars == float("-inf") and by["n3"].useful is None
    assert by["n4"].text == "says NaN, and: Infinity}" and by["true"].text == "[1]" and by["123"].stars == 4.0
    # a number and an object in place of text are null, and their lines stay
    assert sum(r.business_id is None for r in got) >= 3 and any(r.business_id is None and r.stars == 4.5 for r in got)


def test_typed_and_untyped_parse_agree(spark):
    """Every line judged as the value-by-value parse alone judges it."""
    lines = spark.createDataFrame([(x,) for x in [*LINES, *ODD, None]], "value string")
    required = ["business_id", "stars"]
    fast = T.check_lines(lines, S.REVIEW, required, typed=["text"]).collect()
    whole = T._parsed
    try:
        T._parsed = lambda *a: whole(*a).withColumn("_odd", F.lit(True)).withColumn("_v", F.from_json("_line", T._untyped(S.REVIEW)))
        slow = T.check_lines(lines, S.REVIEW, required, typed=["text"]).collect()
    finally:
        T._parsed = whole
    assert [repr(r) for r in fast] == [repr(r) for r in slow]
    assert {r._reason for r in fast} >= {None, "parse_error", "missing_stars"}


def test_lenient_rows_do_not_depend_on_the_selection(spark, tmp_path):
    lines = ['{"review_id":"r1","stars":4}', '{"review_id":"r2","stars":"many"}', '{"review_id":"r3","stars":"3"}', '{"review_id":']
    df = T.read_lenient(spark, write_lines(tmp_path, lines), S.REVIEW)
    assert [(r.review_id, r.stars) for r in df.select("review_id", "stars").collect()] == [("r1", 4.0), ("r2", None), ("r3", 3.0)]
    assert df.count() == df.select("review_id").count() == df.select("stars").count() == 3


def test_required_values_are_checked_by_type(spark):
    lines = spark.createDataFrame(
        [('{"business_id":"b","user_id":"u","stars":"4"}',), ('{"business_id":12,"user_id":"u","stars":4}',),
         ('{"business_id":"b","user_id":["u"],"stars":4}',), ('{"business_id":"b","user_id":null,"stars":4}',),
         ('{"business_id":"b","user_id":"u","stars":"x"}',), ('{"business_id":"b","user_id":"u","stars":4,"useful":"no"}',)],
        "value string",
    )
    checked = T.check_lines(lines, S.REVIEW, ["business_id", "user_id", "stars"]).collect()
    assert [r._reason for r in checked] == [None, "parse_error", "parse_error", "missing_user_id", "parse_error", None]
    assert checked[0].stars == 4.0 and checked[5].useful is None


def test_nested_businesses_keep_hours_and_postal_code(spark, tmp_path):
    line = ('{"business_id":"b","name":"n","location":{"city":"c","state":"s","postal_code":"85001"},"hours":{"Monday":"9:0-17:0"},'
            '"stars":4.0,"review_count":3,"is_open":1,"categories":["x"]}')
    got = D.normalize_business(T.read_json_table(spark, write_lines(tmp_path, [line]), S.BUSINESS_NESTED)).first()
    assert (got.postal_code, got.city, got.hours.Monday, got.category_array) == ("85001", "c", "9:0-17:0", ["x"])
