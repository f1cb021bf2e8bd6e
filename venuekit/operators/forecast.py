"""Review volumes to come: exponential smoothing with trend and season over each business's monthly counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.operators.ranks import attach

SEASON = 12
#: how much of a month's surprise goes into the level, the trend and the season
LEVEL, TREND, SEASONAL = 0.3, 0.05, 0.2

_STATE = "struct<level:double,trend:double,season:array<double>,at:int>"


def month_number(year: Column | str, month: Column | str) -> Column:
    """Months since the year 0."""
    year, month = (F.col(c) if isinstance(c, str) else c for c in (year, month))
    return (year * 12 + month - 1).cast("int")


def monthly_reviews(timed: DataFrame, key: str = "business_id") -> DataFrame:
    """Reviews by business and month number; reviews without a business or a date are left out."""
    dated = timed.where(F.col(key).isNotNull() & F.col("review_year").isNotNull() & F.col("review_month").isNotNull())
    return dated.groupBy(key, month_number("review_year", "review_month").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _place(state: Column) -> Column:
    return (state["at"] % SEASON).cast("int")


def smooth(state: Column, value: Column, level: float = LEVEL, trend: float = TREND, seasonal: float = SEASONAL) -> Column:
    """The state after one more month."""
    here = F.get(state["season"], _place(state))
    base = level * (value - here) + (1 - level) * (state["level"] + state["trend"])
    slope = trend * (base - state["level"]) + (1 - trend) * state["trend"]
    share = seasonal * (value - base) + (1 - seasonal) * here
    season = F.transform(state["season"], lambda s, i: F.when(i == _place(state), share).otherwise(s))
    return F.struct(
        base.alias("level"), slope.alias("trend"), season.alias("season"), (state["at"] + 1).cast("int").alias("at")
    )


def first_state(series: Column, months: Column) -> Column:
    """From the first year: its mean, no trend, and each month's distance from the mean; a shorter series has no season."""
    size = F.least(months, F.lit(SEASON))
    mean = F.aggregate(F.slice(series, 1, size), F.lit(0.0), lambda s, x: s + x) / size
    season = F.transform(
        F.sequence(F.lit(1), F.lit(SEASON)),
        lambda i: F.when(months >= SEASON, F.get(series, (i - 1).cast("int")) - mean).otherwise(F.lit(0.0)),
    )
    return F.struct(mean.alias("level"), F.lit(0.0).alias("trend"), season.alias("season"), size.cast("int").alias("at")).cast(_STATE)


def expected(state: Column, ahead: Column) -> Column:
    """The volume ``ahead`` months after the state's last one, never below 0."""
    season = F.get(state["season"], ((state["at"] + ahead - 1) % SEASON).cast("int"))
    return F.greatest(state["level"] + ahead * state["trend"] + season, F.lit(0.0))


def volume_forecast(
    timed: DataFrame, key: str = "business_id", horizon: int = 12, held: int = 12, level: float = LEVEL,
    trend: float = TREND, seasonal: float = SEASONAL,
) -> DataFrame:
    """(key, year, month, expected, months, held_error): the volume of each of the next ``horizon`` months by business.

    A business's series runs from its first review to the last month that any review is of; months between without reviews
    count 0. The fold over it carries level, trend and season. A series of ``held`` months more than a season is also told by
    how much the ``held`` last months were missed on average by the state before them (``held_error``); for shorter ones that
    is null. The state then takes these months in too, so each month is folded once.

    Scale: reviews are counted by business and month before the shuffle, so a business is at most one row a month, however
    many reviews it has; the fold has no Python in it. A review dated far ahead would lengthen all series: clean dates first.
    """
    monthly = monthly_reviews(timed, key)
    end = timed.where(F.col(key).isNotNull()).agg(F.max(month_number("review_year", "review_month")).alias("_end"))
    counted = monthly.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("month", "n"))).alias("_counts"))
    series = attach(counted, end, ()).select(
        key, "_end",
        F.transform(
            F.sequence(F.array_min(F.map_keys("_counts")), F.col("_end")),
            lambda m: F.coalesce(F.element_at("_counts", m), F.lit(0)).cast("double"),
        ).alias("_series"),
    ).withColumn("months", F.size("_series"))
    fitted = F.when(F.col("months") >= SEASON + held, F.col("months") - held).otherwise(F.col("months"))
    step = lambda state, x: smooth(state, x, level, trend, seasonal)
    series = series.withColumn("_fitted", fitted).withColumn("_first", first_state(F.col("_series"), F.col("_fitted")))
    begun = series.withColumn(
        "_state", F.aggregate(F.slice("_series", F.col("_first.at") + 1, F.col("_fitted") - F.col("_first.at")), F.col("_first"), step)
    )
    rest = F.slice("_series", F.col("_fitted") + 1, F.col("months") - F.col("_fitted"))
    missed = F.transform(rest, lambda x, i: F.abs(x - expected(F.col("_state"), i + 1)))
    ended = begun.select(
        key, "_end", "months", F.aggregate(rest, F.col("_state"), step).alias("_last"),
        F.try_divide(F.aggregate(missed, F.lit(0.0), lambda s, x: s + x), F.size(missed)).alias("held_error"),
    )
    ahead = ended.withColumn("_ahead", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    at = F.col("_end") + F.col("_ahead")
    return ahead.select(
        key, F.floor(at / 12).cast("int").alias("year"), (at % 12 + 1).cast("int").alias("month"),
        expected(F.col("_last"), F.col("_ahead")).alias("expected"), "months", "held_error",
    )
