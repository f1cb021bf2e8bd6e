"""Encoders, sentiment, time parts and hashing on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from venuekit.functions import encode as E
from venuekit.functions.hashing import normal_hash, unit_hash
from venuekit.functions.text import sentiment, utf16_length
from venuekit.functions.timeparts import with_time_parts


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    "encoder, values, expected",
    [
        (E.wifi_ordinal, ["free", "'free'", "paid", "'paid'", "no", "u'free'", None], [2, 2, 1, 1, 0, 0, 0]),
        (E.wifi_fraction, ["free", "'free'", "paid", "'paid'", "no", "u'free'", None], [1, 1, 0.5, 0.5, 0, 0, 0]),
        (E.noise_level, ["quiet", "'average'", "loud", "'very_loud'", "other", None], [1, 2, 3, 4, 2, 2]),
        (E.price_level, ["2", "3.5", "None", "", "x", None], [2, 3.5, 0, 0, 0, 0]),
        (E.true_flag, ["true", "True", "'true'", "'True'", "TRUE", "False", None], [1, 1, 1, 1, 0, 0, 0]),
    ],
)
def test_encoders(spark, encoder, values, expected):
    assert column(spark, values, "string", encoder("x")) == expected


def test_prefix_spelling_is_an_option(spark):
    assert column(spark, ["u'free'", "u'no'"], "string", E.wifi_ordinal("x", strip_prefix=True)) == [2.0, 0.0]


def test_price_nan_stays_nan(spark):
    assert math.isnan(column(spark, ["nan"], "string", E.price_level("x"))[0])


def test_success_variants_differ_on_missing_stars(spark):
    stars = [4.0, 3.5, None]
    assert column(spark, stars, "double", E.success_or_null("x")) == [1.0, 0.0, None]
    assert column(spark, stars, "double", E.success_or_zero("x")) == [1.0, 0.0, 0.0]


def test_clip_keeps_missing(spark):
    values = [-5.0, 0.5, 7.0, None, float("nan")]
    assert column(spark, values, "double", E.clip("x", -1, 2)) == [-1.0, 0.5, 2.0, None, None]
    assert column(spark, [5, 2000], "long", E.clip("x", hi=1000)) == [5.0, 1000.0]


def test_rating_bands(spark):
    stars = [5.0, 4.5, 4.0, 3.0, 2.5, None, float("nan")]
    four = ["darkgreen", "darkgreen", "green", "orange", "red", "red", "red"]
    assert column(spark, stars, "double", E.rating_band("x")) == four
    three = ["green", "green", "green", "blue", "red", "red", "red"]
    assert column(spark, stars, "double", E.rating_band("x", E.RATING_BANDS_3)) == three


def test_main_category(spark):
    values = ["Food, Bars", "Food", "", None]
    assert column(spark, values, "string", E.main_category(E.category_array("x")))[:2] == ["Food", "Food"]
    assert column(spark, [[], None, ["a", "b"]], "array<string>", E.main_category(F.col("x"))) == [
        "uncategorized", "uncategorized", "a",
    ]


def test_labels(spark):
    assert column(spark, [1, 0, None], "int", E.open_label("x")) == ["Open", "Closed", None]
    assert column(spark, [1.0, 0.0, None], "double", E.success_label("x")) == [
        "Successful", "Not Successful", None,
    ]


def test_place_label_fills_gaps(spark):
    df = spark.createDataFrame(
        [(None, 4.5, None, "Tempe", None)], "name string, stars double, review_count long, city string, state string"
    )
    assert df.select(E.place_label()).first()[0] == "Unknown\nStars: 4.5\nReviews: N/A\nCity: Tempe, Unknown"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Great food, great service", 1.0),
        ("good but awful", 0.0),
        ("", 0.0),
        ("Whatever", -1.0),
        ("GOOD best bad", 1 / 3),
        ("nothing to say", 0.0),
    ],
)
def test_sentiment(spark, text, expected):
    assert column(spark, [text], "string", sentiment("x"))[0] == pytest.approx(expected)


def test_sentiment_by_token(spark):
    values = ["Whatever", "I hate it", "good, bad!", "goodness"]
    assert column(spark, values, "string", sentiment("x", mode="token")) == [0.0, -1.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        sentiment("x", mode="stem")


def test_sentiment_reads_the_whole_text(spark):
    long_text = "x " * 200_000 + "worst"
    assert column(spark, [long_text], "string", sentiment("x")) == [-1.0]


def test_utf16_length(spark):
    assert column(spark, ["abc", "é", "😀a", ""], "string", utf16_length("x")) == [3, 1, 3, 0]


def test_time_parts(spark, rows):
    df = spark.createDataFrame(
        [(1, "2021-03-07 23:15:00"), (2, "2021-13-01 00:00:00"), (3, None), (4, "soon")], "id int, date string"
    )
    got = {r["id"]: r for r in rows(with_time_parts(df, "date"))}
    assert (got[1]["review_year"], got[1]["review_month"], got[1]["review_day"], got[1]["review_hour"]) == (
        2021, 3, 1, 23,
    )
    for i in (2, 3, 4):
        assert got[i]["review_year"] is None and got[i]["review_hour"] is None


def test_hash_numbers_do_not_depend_on_partitioning(spark):
    keys = spark.range(5000)
    draw = keys.select("id", unit_hash("id").alias("u"), normal_hash("id").alias("z"))
    once = {r.id: (r.u, r.z) for r in draw.collect()}
    again = keys.repartition(7).select("id", unit_hash("id").alias("u"), normal_hash("id").alias("z"))
    assert once == {r.id: (r.u, r.z) for r in again.collect()}
    u = [a for a, _ in once.values()]
    z = [b for _, b in once.values()]
    assert 0 <= min(u) and max(u) < 1 and abs(sum(u) / len(u) - 0.5) < 0.02
    assert abs(sum(z) / len(z)) < 0.05 and abs(sum(x * x for x in z) / len(z) - 1) < 0.06
