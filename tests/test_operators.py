"""Operators on small hand-made tables, against brute force, and under different partitionings."""

import random
import statistics
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from venuekit import schema as S
from venuekit.operators import activity as A
from venuekit.operators import distribution as X
from venuekit.operators import growth as G
from venuekit.operators import hours as H
from venuekit.operators import metrics as E
from venuekit.operators import places as P
from venuekit.operators import ranks as N
from venuekit.operators import radix as D64
from venuekit.operators import reviews as R
from venuekit.operators import sampling as SM
from venuekit.operators import success as U
from venuekit.sources.tables import corrupt_counts, valid_records


# ---- growth -----------------------------------------------------------------------------------------------------

def reviews_of(spark, per_year, business="b"):
    data = [
        (business, f"{year}-0{1 + i % 9}-01 10:00:00", float(stars))
        for year, (n, stars) in per_year.items()
        for i in range(n)
    ]
    return spark.createDataFrame(data, "business_id string, date string, stars double")


def test_gap_years_make_no_pair(spark, rows):
    timed = A.review_times(reviews_of(spark, {2019: (2, 3), 2020: (4, 4), 2022: (8, 5)}))
    pairs = rows(G.year_pairs(G.yearly_reviews(timed)))
    assert [(p["year1"], p["year2"], p["review_growth"], p["growth_rate"], p["star_change"]) for p in pairs] == [
        (2019, 2020, 2, 1.0, 1.0)
    ]
    assert rows(G.review_growth(timed)) == [
        {"business_id": "b", "avg_growth_rate": 1.0, "avg_star_change": 1.0, "years_with_data": 1}
    ]


def test_undated_reviews_never_pair(spark):
    timed = A.review_times(
        reviews_of(spark, {2019: (1, 3)}).unionByName(
            spark.createDataFrame([("b", "never", 1.0)], "business_id string, date string, stars double")
        )
    )
    yearly = G.yearly_reviews(timed)
    assert yearly.count() == 2
    assert G.year_pairs(yearly).count() == 0


def test_pairs_equal_a_self_join(spark):
    rng = random.Random(5)
    data = [(rng.randrange(40), 2000 + rng.randrange(9), rng.randrange(1, 9), float(rng.randrange(1, 6)))
            for _ in range(160)]
    yearly = spark.createDataFrame(
        list({(b, y): (b, y, n, s) for b, y, n, s in data}.values()),
        "business_id int, review_year int, yearly_reviews long, yearly_avg_stars double",
    )
    a, b = yearly.alias("a"), yearly.alias("b")
    joined = a.join(
        b, (F.col("a.business_id") == F.col("b.business_id"))
        & (F.col("a.review_year") + 1 == F.col("b.review_year"))
    ).select("a.business_id", F.col("a.review_year").alias("year1"),
             (F.col("b.yearly_reviews") - F.col("a.yearly_reviews")).alias("review_growth"))
    got = G.year_pairs(yearly).select("business_id", "year1", "review_growth")
    assert sorted(got.collect()) == sorted(joined.collect())


def test_growth_is_stable_under_partitioning(spark):
    rng = random.Random(1)
    # one business has a third of all reviews
    data = [
        (0 if rng.random() < 0.33 else rng.randrange(1, 50), f"{rng.randrange(2010, 2020)}-05-01 00:00:00",
         float(rng.randrange(1, 6)))
        for _ in range(5000)
    ]
    df = spark.createDataFrame(data, "business_id long, date string, stars double")
    results = []
    for n in (1, 7, 64):
        out = G.review_growth(A.review_times(df.repartition(n)))
        results.append(sorted((r[0], round(r[1], 9), round(r[2], 9), r[3]) for r in out.collect()))
    assert results[0] == results[1] == results[2]


def test_correlation_words(spark, rows):
    def strength(points):
        df = spark.createDataFrame(points, "avg_star_change double, avg_growth_rate double")
        return rows(G.growth_rating_correlation(df))[0]["strength"]

    assert strength([(0.1, 0.1), (0.2, 0.2), (0.3, 0.4)]) == "strong positive"
    assert strength([(0.1, 0.3), (0.2, 0.2), (0.3, 0.1)]) == "negative"
    assert strength([(0.1, 0.1)]) == "undefined"
    assert strength([(0.1, 0.1), (None, 0.2)]) == "undefined"


def test_growth_is_clipped_before_correlation(spark, rows):
    df = spark.createDataFrame([("a", 9.0, -4.0), ("b", None, 0.5)],
                               "business_id string, avg_growth_rate double, avg_star_change double")
    assert rows(G.clip_growth(df)) == [
        {"business_id": "a", "avg_growth_rate": 2.0, "avg_star_change": -1.0},
        {"business_id": "b", "avg_growth_rate": None, "avg_star_change": 0.5},
    ]


def test_extremes_break_ties_by_key(spark):
    pairs = spark.createDataFrame([("c", 1.0, 2000), ("a", 1.0, 2001), ("a", 1.0, 2000), ("b", 0.0, 2000)],
                                  "business_id string, growth_rate double, year1 int")
    top = [(r[0], r[2]) for r in G.extreme_growth(pairs, 3).collect()]
    assert top == [("a", 2000), ("a", 2001), ("c", 2000)]
    assert G.extreme_growth(pairs, 1, top=False).first()[0] == "b"


# ---- activity ---------------------------------------------------------------------------------------------------

def test_checkin_shapes_agree(spark):
    stamps = ["2020-01-06 09:30:00", "2020-01-07 22:00:00"]
    listed = spark.createDataFrame([("b", ", ".join(stamps))], S.CHECKIN_LIST)
    mapped = spark.createDataFrame([("b", dict.fromkeys(stamps, 1))], S.CHECKIN_MAP)
    paired = spark.createDataFrame([("b", [(t, 1) for t in stamps])], S.CHECKIN_PAIRS)
    expected = [("b", stamps[0], 1, "Monday", 9), ("b", stamps[1], 1, "Tuesday", 22)]
    for shape in (listed, mapped, paired):
        assert sorted(tuple(r) for r in A.expand_checkins(shape).collect()) == expected


def test_checkin_edge_cases(spark):
    df = spark.createDataFrame(
        [("one", "2020-01-06 09:30:00"), ("comma", "2020-01-06 09:30:00, "), ("bad", "2020-99-99 00:00:00"),
         ("none", None)], S.CHECKIN_LIST,
    )
    got = sorted(tuple(r) for r in A.expand_checkins(df).collect())
    assert got == [
        ("bad", "2020-99-99 00:00:00", 1, None, None),
        ("comma", "2020-01-06 09:30:00", 1, "Monday", 9),
        ("one", "2020-01-06 09:30:00", 1, "Monday", 9),
    ]
    with pytest.raises(ValueError):
        A.expand_checkins(spark.createDataFrame([("b", 1)], "business_id string, time int"))


def test_routing(spark):
    records = spark.createDataFrame(
        [("r", "2020-01-06 09:30:00", "2020-01-07 00:00:00"), ("c", None, "2020-01-07 10:00:00"),
         ("skip", None, None), ("bad", "soon", None)],
        "business_id string, date string, time string",
    )
    assert sorted(tuple(r) for r in A.route_activity(records).collect()) == [
        ("c", "checkin", "Tuesday", 10), ("r", "review", "Monday", 9),
    ]


def test_mixed_lines(spark, rows):
    lines = spark.createDataFrame(
        [('{"business_id":"r","date":"2020-01-06 09:30:00"}',),
         ('{"business_id":"c","time":{"2020-01-07 10:00:00":2,"2020-01-08 11:00:00":1,"soon":5}}',),
         ('{"business_id":"both","date":"2020-01-06 00:00:00","time":{"2020-01-07 10:00:00":2}}',),
         ('{"business_id":"month","date":"2020-13-06 00:00:00"}',),
         ('{"business_id":"text","time":"not a map"}',), ('{"date":"2020-01-06 09:30:00"}',),
         ('{"business_id":"neither"}',), ("{cut",)],
        "value string",
    )
    checked = A.check_activity(lines)
    assert {r["reason"]: r["n"] for r in rows(corrupt_counts(checked))} == {"parse_error": 2, "bad_date": 1}
    assert sorted(tuple(r) for r in A.route_records(valid_records(checked)).collect()) == [
        ("both", "review", "Monday", 0, 1), ("c", "checkin", "Tuesday", 10, 2), ("c", "checkin", "Wednesday", 11, 1),
        ("r", "review", "Monday", 9, 1),
    ]


def test_profile_of_a_hot_business(spark):
    """One business with a third of the records comes out as under brute force."""
    rng = random.Random(4)
    data = [("hot" if rng.random() < 0.33 else f"b{rng.randrange(30)}", rng.choice(["review", "checkin", "other"]),
             rng.choice(S.WEEKDAYS), rng.randrange(24)) for _ in range(4000)]
    activity = spark.createDataFrame(data, "business_id string, kind string, day_of_week string, hour_of_day int")
    for n in (1, 16):
        got = {r.business_id: r for r in A.temporal_profile(activity.repartition(n)).collect()}
        for b in ("hot", "b3"):
            mine = [r for r in data if r[0] == b]
            assert [(s.reviews, s.checkins) for s in got[b].day_profile] == [
                (sum(r[1] == "review" and r[2] == d for r in mine), sum(r[1] == "checkin" and r[2] == d for r in mine))
                for d in S.WEEKDAYS
            ]
            assert [s.reviews for s in got[b].hour_profile] == [
                sum(r[1] == "review" and r[3] == h for r in mine) for h in range(24)
            ]


def test_profile_is_zero_filled_and_sums_up(spark):
    data = [("b", "review", "Monday", 9), ("b", "checkin", "Sunday", 23), ("b", "checkin", "Sunday", 0),
            ("c", "review", "Friday", 12)]
    activity = spark.createDataFrame(data, "business_id string, kind string, day_of_week string, hour_of_day int")
    profile = A.temporal_profile(activity)
    first = profile.filter("business_id = 'b'").first()
    assert [s.slot for s in first.day_profile] == S.WEEKDAYS
    assert [s.slot for s in first.hour_profile] == [f"{h:02d}" for h in range(24)]
    assert (first.day_profile[0].reviews, first.day_profile[6].checkins) == (1, 2)
    long = A.temporal_profile_long(profile)
    assert long.count() == 2 * 31
    totals = long.groupBy("unit").agg(F.sum(F.col("reviews") + F.col("checkins"))).collect()
    assert {r[0]: r[1] for r in totals} == {"day": 4, "hour": 4}
    line = A.profile_line(profile).filter("business_id = 'b'").first().line
    assert line.startswith("day_profile:Monday:1/0,Tuesday:0/0") and "|hour_profile:00:0/1,01:0/0" in line


def test_calendar_rollup_equals_direct_report(spark):
    timed = A.review_times(reviews_of(spark, {2019: (7, 3), 2020: (9, 5)}))
    direct = sorted(A.reviews_by(timed, "review_month").collect())
    assert sorted(A.rollup_calendar(A.calendar_counts(timed), "review_month").collect()) == direct


def test_weekday_order(spark):
    by_day = spark.createDataFrame([(7, 1), (1, 2), (2, 3)], "review_day int, review_count int")
    assert [r.day_name for r in A.name_weekdays(by_day).collect()] == ["Sunday", "Monday", "Saturday"]


# ---- reviews and places -----------------------------------------------------------------------------------------

def test_sentiment_rollup(spark, rows):
    reviews = spark.createDataFrame(
        [("b", "u1", 3.7, "good"), ("b", "u1", 5.0, "bad bad"), ("b", "u2", 4.0, ""), ("c", "u3", 1.0, "😀")],
        "business_id string, user_id string, stars double, text string",
    )
    got = {r["business_id"]: r for r in rows(R.sentiment_rollup(R.score_reviews(reviews)))}
    assert got["b"] == {"business_id": "b", "total_reviews": 3, "avg_stars": 4.0, "avg_sentiment": 0.0,
                        "avg_text_length": 11 / 3, "unique_users": 2}
    assert got["c"]["avg_text_length"] == 2.0
    approx = rows(R.sentiment_rollup(R.score_reviews(reviews), approx_users=True))
    assert {r["unique_users"] for r in approx} == {2, 1}


def places_frame(spark):
    return spark.createDataFrame(
        [("a", "A", 4.5, 10, 1, "Food, Bars", 33.4, -112.0, "Phoenix", "AZ", "85001"),
         ("b", "B", 3.0, 0, 0, None, 0.0, -112.0, "Phoenix", "AZ", "85001"),
         ("c", "C", None, 5, None, "", 36.1, None, "Vegas", "NV", "89101"),
         ("d", "D", 2.0, 7, 1, "Shops", 36.2, -115.1, "Vegas", "NV", "89101")],
        "business_id string, name string, stars double, review_count long, is_open long, categories string, "
        "latitude double, longitude double, city string, state string, postal_code string",
    ).withColumn("category_array", F.split("categories", ", "))


def test_directory_leaves_out_incomplete_rows(spark):
    got = P.location_directory(places_frame(spark)).orderBy("business_id").collect()
    assert [(r.location, r.business_id, r.main_category) for r in got] == [
        ("AZ:Phoenix", "a", "Food"), ("AZ:Phoenix", "b", "uncategorized"), ("NV:Vegas", "d", "Shops"),
    ]
    line = P.directory_line(P.location_directory(places_frame(spark))).filter("business_id = 'a'").first().line
    assert line == "a|A|Food|4.5|10"


def test_zero_coordinates(spark):
    df = places_frame(spark)
    assert {r[0] for r in P.geojson_features(df).select("business_id").collect()} == {"a", "d"}
    assert {r[0] for r in P.geojson_features(df, drop_zero=False).select("business_id").collect()} == {"a", "b", "d"}


def test_map_points_skip_missing_coordinates(spark):
    got = {r.business_id: r.color for r in P.map_points(places_frame(spark)).collect()}
    assert got == {"a": "darkgreen", "b": "orange", "d": "red"}


def test_top_state_places(spark):
    df = places_frame(spark).unionByName(places_frame(spark).filter("business_id = 'a'"))
    assert {r.state for r in P.top_state_places(df, 1).collect()} == {"AZ"}


def test_hours(spark, rows):
    kind = S.HOURS_TYPE.simpleString()
    all_days, none, week = tuple(["9-5"] * 7), tuple([None] * 7), tuple(["9-5"] * 5 + [None] * 2)
    df = spark.createDataFrame([(1, 4.0, all_days), (2, 2.0, none), (3, 3.0, week), (4, 1.0, None)],
                               f"id int, stars double, hours {kind}")
    assert rows(H.hours_coverage(df)) == [{"with_hours": 3, "total": 4, "share": 0.75}]
    assert rows(H.open_by_weekday(df))[0]["monday_count"] == 2
    assert rows(H.open_by_weekday(df))[0]["sunday_count"] == 1
    got = {r["days_open"]: (r["avg_stars"], r["business_count"]) for r in rows(H.rating_by_days_open(df))}
    assert got == {7: (4.0, 1), 0: (2.0, 1), 5: (3.0, 1)}
    assert rows(H.hours_coverage(df.filter("id > 9")))[0]["share"] is None


def test_unknown_never_counts_as_open(spark, rows):
    df = spark.createDataFrame([(4.0, 1, 1.0), (2.0, None, 0.0), (None, 0, None)],
                               "stars double, is_open int, success double")
    got = rows(U.kpis(df))[0]
    assert got["businesses"] == 3 and got["avg_rating"] == 3.0 and got["success_pct"] == 50.0
    assert got["open_pct"] == pytest.approx(100 / 3)


# ---- distributions ----------------------------------------------------------------------------------------------

def numbers(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")


def test_histogram_matches_numpy(spark):
    rng = random.Random(3)
    values = [rng.expovariate(1.0) for _ in range(500)] + [None, float("nan")]
    got = X.histogram(numbers(spark, values), "x", 12).orderBy("bin").collect()
    counts, edges = np.histogram([round(v, 9) for v in values[:500]], 12)
    assert [r.n for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_one_value(spark):
    got = X.histogram(numbers(spark, [3, 3, 3]), "x", 4).orderBy("bin").collect()
    assert sum(r.n for r in got) == 3 and got[0].bin_start == 2.5 and got[-1].bin_end == 3.5


def test_density_matches_brute_force(spark):
    values = [1.0, 1.5, 1.5, 2.0, 4.0, 4.5]
    got = X.density_curve(numbers(spark, values), "x", 50).orderBy("point").collect()
    h = len(values) ** -0.2 * statistics.stdev(values)
    grid = np.linspace(1.0, 4.5, 50)
    want = [sum(np.exp(-0.5 * ((x - v) / h) ** 2) for v in values) / (len(values) * h * np.sqrt(2 * np.pi))
            for x in grid]
    assert [r.x for r in got] == pytest.approx(grid.tolist())
    assert [r.density for r in got] == pytest.approx(want)


def test_density_without_spread_is_unknown(spark):
    for values in ([2.0], [3.0, 3.0, 3.0]):
        assert {r.density for r in X.density_curve(numbers(spark, values), "x", 5).collect()} == {None}


def test_empty_input(spark):
    none = numbers(spark, [])
    assert sum(r.n for r in X.histogram(none, "x", 3).collect()) == 0
    assert X.density_curve(none, "x", 3).count() == 0
    assert N.running_totals(N.value_counts(none, "x"), ["n"]).count() == 0
    assert X.scatter_bins(none.withColumn("y", F.col("x")), "x", "y", 2, 2).count() == 0
    assert E.regression_metrics(none.withColumn("prediction", F.col("x")), "x").first().n == 0
    assert E.auc(none.withColumn("y", F.col("x")), "y", "x").first().auc is None


def test_box_stats_match_numpy(spark):
    rng = random.Random(2)
    # one group holds most of the rows, another a single value
    data = [("big", rng.lognormvariate(0, 1.5)) for _ in range(900)] + [("small", float(i)) for i in range(7)]
    data += [("one", 4.0), ("big", None), (None, 1.0), ("big", float("nan")), ("none", None)]
    df = spark.createDataFrame(data, "g string, x double").repartition(5)
    got = {r.g: r for r in X.box_stats(df, "x", ["g"]).collect()}
    assert set(got) == {"big", "small", "one"}
    for group in got:
        values = np.array([x for g, x in data if g == group and x is not None and x == x])
        q1, q2, q3 = np.percentile(values, [25, 50, 75])
        inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        r = got[group]
        assert [r.q1, r.median, r.q3] == pytest.approx([q1, q2, q3])
        assert (r.n, r.outliers) == (len(values), len(values) - len(inside))
        assert (r.whisker_low, r.whisker_high) == (inside.min(), inside.max())
    whole = X.box_stats(df, "x", []).first()
    assert whole.n == 909 and whole.median == pytest.approx(np.median([x for _, x in data if x is not None and x == x]))
    assert X.box_stats(df.where("false"), "x", ["g"]).count() == 0


def bits_of(x):
    """The number whose order is that of doubles, from their stored bits."""
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def test_ordered_keys_are_the_bits_of_a_double(spark):
    rng = random.Random(8)
    values = [0.0, -0.0, 1.0, -1.0, 2.0**-1074, -(2.0**-1074), 2.0**-1022, 2.0**-1023, 1.7976931348623157e308, float("inf"), float("-inf")]
    values += [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(-1074, 1023) for _ in range(3000)]
    for e in range(-1073, 1024):
        near = 2.0**e
        values += [near, np.nextafter(near, 0.0).item(), np.nextafter(near, np.inf).item()]
    df = numbers(spark, [*values, None, float("nan")])
    got = [(r.x, r.k) for r in df.select("x", D64.ordered_key(F.col("x")).alias("k")).collect()]
    assert sum(k is None for _, k in got) == 2
    assert all(k == bits_of(x) for x, k in got if k is not None)


@pytest.mark.parametrize("spread", ["ties", "close", "wide", "ends"])
def test_quantiles_match_numpy(spark, spread):
    rng = random.Random(spread)
    draw = {
        "ties": lambda: rng.choice([0.0, -0.0, 1.0, 2.5]), "close": lambda: 1.0 + rng.randrange(50) * 2.0**-52,
        "wide": lambda: rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300), "ends": lambda: rng.choice([-5e-324, 5e-324, -1e308, 3.0]),
    }[spread]
    data = [(rng.choice("aab"), draw()) for _ in range(501)]
    keys = D64.keyed_values(spark.createDataFrame(data, "g string, x double").repartition(4), "x", ["g"])
    parts = {"p0": 0.0, "p1": 0.37, "p5": 0.5, "p9": 0.9, "end": 1.0}
    for r in D64.quantiles(keys, parts, ["g"]).collect():
        values = sorted(x for g, x in data if g == r.g)
        assert r.n == len(values)
        for name, p in parts.items():
            at = (len(values) - 1) * p
            low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            assert r[name] == pytest.approx(low if low == high else low + (high - low) * (at - int(at)), rel=1e-12)


@pytest.mark.parametrize("rows", [0, 1, 700])
def test_ranks_across_tasks(spark, rows):
    rng = random.Random(rows)
    data = [(rng.randrange(40), f"c{i:04d}") for i in range(rows)]
    df = spark.createDataFrame(data, "n int, name string").repartition(5)
    got = {r.name: r["rank"] for r in N.ranked(df, [F.col("n").desc(), F.col("name")]).collect()}
    want = [name for _, name in sorted(data, key=lambda r: (-r[0], r[1]))]
    assert got == {name: i for i, name in enumerate(want)}


@pytest.mark.parametrize("points", [2, 30, 200])
def test_density_of_many_values_and_of_outliers(spark, points):
    rng = random.Random(points)
    values = [rng.gauss(0, 1) for _ in range(300)] + [rng.choice([5.0, 6.0]) for _ in range(100)] + [400.0, -90.0]
    got = X.density_curve(numbers(spark, values), "x", points).orderBy("point").collect()
    h = len(values) ** -0.2 * statistics.stdev(values)
    want = [sum(np.exp(-0.5 * ((x - np.array(values)) / h) ** 2)) / (len(values) * h * np.sqrt(2 * np.pi))
            for x in np.linspace(-90.0, 400.0, points)]
    assert np.abs(np.array([r.density for r in got]) - np.array(want)).max() < 1e-11 / h


@pytest.mark.parametrize("ranges", [2, 8, 64])
def test_running_totals_match_brute_force(spark, ranges):
    rng = random.Random(ranges)
    values = [rng.choice([0.0, -0.0, 1.0, 2.0, rng.random() * 50]) for _ in range(400)]
    freq = N.value_counts(numbers(spark, values), "x")
    for row in N.running_totals(freq, ["n"], ranges=ranges).collect():
        assert row.before_n == sum(v < row.v for v in values)
        assert row.n == sum(v == row.v for v in values)
        assert row.all_n == len(values)


def test_scatter_bins_count_every_point(spark):
    df = spark.createDataFrame([(float(i % 7), float(i % 3)) for i in range(100)] + [(None, 1.0)],
                               "a double, b double")
    cells = X.scatter_bins(df, "a", "b", 4, 3).collect()
    assert sum(r.n for r in cells) == 100 and max(r.x_bin for r in cells) == 4


# ---- samples ----------------------------------------------------------------------------------------------------

def test_split_is_disjoint_and_complete(spark):
    df = spark.range(2000)
    train, test = SM.split(df, "id", 0.8)
    a, b = {r.id for r in train.collect()}, {r.id for r in test.repartition(9).collect()}
    assert not a & b and len(a | b) == 2000 and 0.75 < len(a) / 2000 < 0.85
    assert a == {r.id for r in SM.split(df.repartition(13), "id", 0.8)[0].collect()}


def test_samples(spark):
    df = spark.range(500)
    assert SM.sample_rows(df, "id", 100).count() == 100
    assert SM.sample_rows(df, "id", 1000).count() == 500
    tenth = SM.sample_fraction(df, "id", 0.1).count()
    assert 25 < tenth < 80 and SM.sample_fraction(df, "id", 0.1, limit=5).count() == 5
    assert SM.sample_rows(df, "id", 5, seed=1).collect() != SM.sample_rows(df, "id", 5, seed=2).collect()


# ---- metrics ----------------------------------------------------------------------------------------------------

PAIRS = [(1, 1)] * 3 + [(1, 0)] + [(0, 0)] * 3 + [(0, 1)]


def labelled(spark, pairs):
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "success double, prediction double")


def test_classification_metrics(spark, rows):
    df = labelled(spark, PAIRS)
    assert rows(E.classification_metrics(df)) == [dict.fromkeys(["accuracy", "precision", "recall", "f1"], 0.75)]
    cells = {(r["actual"], r["predicted"]): (r["n"], r["row_pct"]) for r in rows(E.confusion_matrix(df))}
    assert cells == {(0, 0): (3, 75.0), (0, 1): (1, 25.0), (1, 0): (1, 25.0), (1, 1): (3, 75.0)}
    report = {r["class"]: r for r in rows(E.class_report(df))}
    assert report["macro avg"]["f1"] == 0.75 and report["weighted avg"]["support"] == 8


def test_metrics_without_positives(spark, rows):
    df = labelled(spark, [(0, 0), (0, 0)])
    assert rows(E.classification_metrics(df)) == [{"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}]
    assert [r["n"] for r in rows(E.confusion_matrix(df))] == [2, 0, 0, 0]


def test_rows_without_prediction_are_left_out(spark, rows):
    df = labelled(spark, PAIRS).unionByName(
        spark.createDataFrame([(1.0, None), (None, 1.0)], "success double, prediction double")
    )
    assert sum(r["n"] for r in rows(E.confusion_matrix(df))) == len(PAIRS)


def test_auc_against_brute_force_and_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(8)
    data = []
    for _ in range(400):
        y = float(rng.random() < 0.4)
        data.append((y, round(rng.gauss(y, 1.2), 1)))
    df = spark.createDataFrame(data, "y double, s double").repartition(6)
    pos, neg = [s for y, s in data if y == 1], [s for y, s in data if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = E.auc(df, "y", "s").first()
    assert got.auc == pytest.approx(want) and (got.positives, got.negatives) == (len(pos), len(neg))
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0)
    # the evaluator tells -0.0 from 0.0, so it gets them as one
    assert evaluator.evaluate(df.withColumn("s", F.col("s") + F.lit(0.0))) == pytest.approx(want)


def test_auc_of_one_class_is_unknown(spark):
    df = spark.createDataFrame([(1.0, 0.3), (1.0, 0.4)], "y double, s double")
    assert E.auc(df, "y", "s").first().auc is None


def test_regression_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    rng = random.Random(2)
    df = spark.createDataFrame([(rng.gauss(3, 1), rng.gauss(3, 1)) for _ in range(200)],
                               "stars double, prediction double")
    got = E.regression_metrics(df).first()
    evaluator = RegressionEvaluator(labelCol="stars", predictionCol="prediction")
    assert got.rmse == pytest.approx(evaluator.evaluate(df))
    assert got.r2 == pytest.approx(evaluator.setMetricName("r2").evaluate(df))


def test_histogram_of_a_tiny_range(spark):
    from venuekit.operators import distribution

    values = spark.createDataFrame([(1e-11 * i,) for i in range(100)], "v double")
    assert [r.n for r in distribution.histogram(values, "v", 10).orderBy("bin").collect()] == [10] * 10


def test_null_business_has_no_growth(spark):
    from venuekit.operators import growth

    yearly = spark.createDataFrame([(None, 2019, 2, 3.0), (None, 2020, 4, 3.5), ("b", 2019, 1, 4.0), ("b", 2020, 3, 5.0)],
                                   "business_id string, review_year int, yearly_reviews long, yearly_avg_stars double")
    assert [r.business_id for r in growth.growth_metrics(growth.year_pairs(yearly)).collect()] == ["b"]


def test_unknown_levels_states_and_businesses_are_left_out(spark):
    from venuekit.operators import activity, places, success

    rated = spark.createDataFrame([(float("nan"), 1.0), (2.0, 1.0), (None, 0.0)], "price_level double, success double")
    assert [r.price_level for r in success.success_by(rated, "price_level").collect()] == [2.0]
    states = spark.createDataFrame([(None,), (None,), ("AZ",)], "state string")
    assert [r.state for r in places.top_counts(states, "state", k=2, keep_null=False).collect()] == ["AZ"]
    assert [r.state for r in places.top_counts(states, "state", k=2).collect()] == [None, "AZ"]
    records = spark.createDataFrame([(None, "2020-03-08 02:30:00", None), ("b", "2020-03-08 02:30:00", None)],
                                    "business_id string, date string, time string")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert [(r.business_id, r.hour_of_day) for r in activity.route_activity(records).collect()] == [("b", 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scatter_has_all_points(spark):
    from venuekit.operators import distribution

    points = spark.range(2500).selectExpr("id", "double(id) x", "if(id % 100 = 0, null, double(id)) y")
    assert distribution.scatter_points(points, "id", ["x", "y"]).count() == 2475
    assert distribution.scatter_points(points, "id", ["x", "y"], n=10).count() == 10
