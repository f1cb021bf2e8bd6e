"""Opening hours: coverage, open days and their relation to ratings."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.schema import WEEKDAYS


def _day(day: str, hours: str) -> Column:
    return F.col(f"{hours}.{day}")


def hours_coverage(business: DataFrame, hours: str = "hours") -> DataFrame:
    """Businesses with opening hours, all businesses, and the share, in one pass."""
    return business.agg(
        F.count(hours).alias("with_hours"), F.count(F.lit(1)).alias("total")
    ).withColumn("share", F.try_divide("with_hours", "total"))


def open_by_weekday(business: DataFrame, hours: str = "hours") -> DataFrame:
    """Number of businesses open on each weekday, one column per day."""
    return business.filter(F.col(hours).isNotNull()).agg(
        *[F.count(_day(day, hours)).alias(f"{day.lower()}_count") for day in WEEKDAYS]
    )


def rating_by_days_open(business: DataFrame, hours: str = "hours") -> DataFrame:
    """Mean stars and number of businesses by days open per week."""
    days = reduce(add, [_day(day, hours).isNotNull().cast("int") for day in WEEKDAYS])
    return (
        business.filter(F.col(hours).isNotNull())
        .groupBy(days.alias("days_open"))
        .agg(F.avg("stars").alias("avg_stars"), F.count(F.lit(1)).alias("business_count"))
    )
