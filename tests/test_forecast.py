import random

import pytest

from venuekit.operators import forecast as P

TIMED = "business_id string, review_year int, review_month int"


def plain(series, held=12, horizon=12):
    """The recursion month by month, in plain numbers."""

    def step(state, x):
        level, trend, season, at = state
        here = season[at % 12]
        base = P.LEVEL * (x - here) + (1 - P.LEVEL) * (level + trend)
        season = list(season)
        season[at % 12] = P.SEASONAL * (x - base) + (1 - P.SEASONAL) * here
        return base, P.TREND * (base - level) + (1 - P.TREND) * trend, season, at + 1

    def ahead(state, h):
        level, trend, season, at = state
        return max(level + h * trend + season[(at + h - 1) % 12], 0.0)

    fitted = len(series) - held if len(series) >= 12 + held else len(series)
    first = series[: min(fitted, 12)]
    mean = sum(first) / len(first)
    state = (mean, 0.0, [x - mean for x in first] if fitted >= 12 else [0.0] * 12, len(first))
    for x in series[len(first) : fitted]:
        state = step(state, x)
    rest = series[fitted:]
    error = sum(abs(x - ahead(state, i + 1)) for i, x in enumerate(rest)) / len(rest) if rest else None
    for x in rest:
        state = step(state, x)
    return [ahead(state, h + 1) for h in range(horizon)], error


def reviews(spark, volumes, start=2010 * 12):
    """One review row for each count of {business: series}, all series ending in the same month."""
    longest = max(map(len, volumes.values()))
    rows = []
    for b, series in volumes.items():
        for i, n in enumerate(series):
            month = start + longest - len(series) + i
            rows += [(b, month // 12, month % 12 + 1)] * n
    return spark.createDataFrame(rows, TIMED).repartition(5)


def test_equals_the_plain_recursion(spark):
    rng = random.Random(6)
    volumes = {f"b{n}": [1, *[rng.randint(0, 6) for _ in range(n - 1)]] for n in (1, 5, 11, 12, 13, 23, 24, 25, 60)}
    volumes["b60"][-1] = 3
    got = {}
    for r in P.volume_forecast(reviews(spark, volumes)).collect():
        got.setdefault(r.business_id, []).append((r.year * 12 + r.month - 1, r.expected, r.held_error, r.months))
    for b, series in volumes.items():
        want, error = plain(series)
        rows = sorted(got[b])
        assert [r[0] for r in rows] == [2010 * 12 + 60 + h for h in range(12)]
        assert [r[1] for r in rows] == pytest.approx(want)
        assert rows[0][2] == (pytest.approx(error) if error is not None else None)
        assert rows[0][3] == len(series)


def test_a_season_is_told_ahead(spark):
    yearly = [2, 2, 3, 4, 6, 9, 12, 9, 6, 4, 3, 2]
    rows = sorted(P.volume_forecast(reviews(spark, {"a": yearly * 5})).collect(), key=lambda r: (r.year, r.month))
    assert [r.expected for r in rows] == pytest.approx(yearly) and rows[0].held_error == pytest.approx(0)


def test_growth_goes_on(spark):
    rows = sorted(P.volume_forecast(reviews(spark, {"a": [2 * i + 1 for i in range(72)]})).collect(), key=lambda r: (r.year, r.month))
    assert all(a.expected < b.expected for a, b in zip(rows, rows[1:])) and rows[0].expected > 120


def test_reviews_without_a_business_or_a_date_play_no_part(spark):
    clean = reviews(spark, {"a": [1, 2, 3]})
    dirty = clean.union(spark.createDataFrame([(None, 2050, 1), ("a", None, None)], TIMED))
    assert sorted(P.volume_forecast(dirty).collect()) == sorted(P.volume_forecast(clean).collect())
    assert P.volume_forecast(spark.createDataFrame([], TIMED)).count() == 0


def test_a_business_is_a_row_a_month_before_its_fold(spark, capsys):
    P.volume_forecast(reviews(spark, {"a": [1, 2]})).explain("formatted")
    plan = capsys.readouterr().out
    assert "PythonUDF" not in plan and "Window" not in plan


def test_any_partitioning(spark):
    rng = random.Random(2)
    volumes = {"hot": [rng.randint(20, 60) for _ in range(40)], **{f"b{i}": [1, 0, 2, 1] for i in range(20)}}
    df = reviews(spark, volumes)
    results = [sorted(P.volume_forecast(df.repartition(n)).collect()) for n in (1, 9)]
    assert results[0] == results[1]
