"""Headline figures, success rates, ratings by state and opening hours."""

import uuid

from pyspark.sql import functions as F

from venue_queries import views as V
from venue_queries.growth import metrics as growth_metrics
from venue_queries.growth import timed
from venue_queries.io import geo
from venue_queries.registry import query, r, rounded
from venuekit.operators import growth as G
from venuekit.operators import hours as H
from venuekit.operators import success as S
from venuekit.plans import datasets as D
from venuekit.plans import refresh as RF
from venuekit.session import new_path
from venuekit.sinks.tables import write_bucketed

WEEK = list(V.CLOSED_EVERY)


def analysis(spark, d):
    return D.analysis_from(V.businesses(spark, d), V.reviews(spark, d))


@query("analysis_dataset", f"""
select business_id, name, stars, review_count, is_open, has_wifi, price_level, noise_level,
       {r('avg_review_stars')} as avg_review_stars, {r('avg_useful')} as avg_useful, {r('avg_funny')} as avg_funny,
       {r('avg_cool')} as avg_cool, success from analysis_v""", "analysis_v")
def analysis_dataset(spark, d):
    return rounded(analysis(spark, d))


def _bucketed(spark, d):
    """Businesses and reviews in buckets by business_id, under names of their own."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"venuekit_{uuid.uuid4().hex}"
    return (
        write_bucketed(V.businesses(spark, d), f"{name}_business", "business_id", width),
        write_bucketed(timed(spark, d), f"{name}_review", "business_id", width),
    )


@query("bucketed_analysis", f"""
select business_id, stars, {r('avg_review_stars')} as avg_review_stars, {r('avg_useful')} as avg_useful, success,
       {r('avg_growth_rate')} as avg_growth_rate, coalesce(years_with_data, 0) as years_with_data
from analysis_v left join growth_v using (business_id)""", "analysis_v", "growth_v")
def bucketed_analysis(spark, d):
    # joins and summaries by business from tables that are stored by business
    business, reviews = _bucketed(spark, d)
    data = D.analysis_from(business, reviews).join(G.review_growth(reviews), "business_id", "left").select(
        "business_id", "stars", "avg_review_stars", "avg_useful", "success", "avg_growth_rate",
        F.coalesce("years_with_data", F.lit(0)).alias("years_with_data"),
    )
    return rounded(data)


@query("refresh_equals_rebuild", f"""
select business_id, count(*) as review_count, {r('avg(stars)')} as avg_review_stars, {r('avg(useful)')} as avg_useful,
       {r('avg(funny)')} as avg_funny, {r('avg(cool)')} as avg_cool from review_v group by business_id""", "review_v")
def refresh_equals_rebuild(spark, d):
    # an old dump, which lacks some reviews of two years; then these years anew
    reviews = timed(spark, d)
    late = F.col("review_year").isin(1994, 1997)
    path = new_path(spark, "states")
    RF.refresh(reviews.where(~late | (F.col("review_id") % 3 > 0)), path)
    RF.refresh(reviews, path, [1994, 1997])
    summary = RF.merged(spark.read.parquet(path))
    return rounded(summary.select(
        "business_id", "review_count", "avg_review_stars", "avg_useful", "avg_funny", "avg_cool"
    ))


@query("kpis", f"""
select count(*) as businesses, {r('avg(stars)')} as avg_rating,
       {r('avg(case when is_open = 1 then 1.0 else 0.0 end) * 100')} as open_pct, {r('avg(success) * 100')} as success_pct
from analysis_v""", "analysis_v")
def kpis(spark, d):
    return rounded(S.kpis(analysis(spark, d)))


@query("reviews_by_star", f"""
select stars, {r('avg(review_count)')} as avg_review_count from analysis_v group by stars""", "analysis_v")
def reviews_by_star(spark, d):
    return rounded(S.reviews_by_star(analysis(spark, d)))


@query("success_by_star", f"""
select stars, {r('avg(success) * 100')} as success_pct from analysis_v group by stars""", "analysis_v")
def success_by_star(spark, d):
    return rounded(S.success_by_star(analysis(spark, d)))


def _success_by(level):
    @query(f"success_by_{level.split('_')[0]}", f"""
select {level}, {r('avg(success)')} as success_rate, count(*) as n from analysis_v group by {level}""", "analysis_v")
    def run(spark, d):
        return rounded(S.success_by(analysis(spark, d), level))

    return run


_success_by("price_level")
_success_by("noise_level")


@query("success_by_years", f"""
select years_with_data, {r('avg(success)')} as success_rate, count(*) as n
from analysis_v join growth_v using (business_id) group by years_with_data""", "analysis_v", "growth_v")
def success_by_years(spark, d):
    joined = D.chart_frame(analysis(spark, d), growth_metrics(spark, d), ["years_with_data"])
    return rounded(S.success_by(joined, "years_with_data"))


@query("success_counts", """
select case success when 1 then 'Successful' else 'Not Successful' end as category, count(*) as n
from analysis_v where success is not null group by 1""", "analysis_v")
def success_counts(spark, d):
    return S.success_counts(analysis(spark, d))


@query("state_rating_min50", f"""
select state, {r('avg(stars)')} as avg_stars, count(*) as business_count from geo_v group by state
having count(*) > 50 order by round(avg(stars), 9) desc, state limit 10""", "geo_v")
def state_rating_min50(spark, d):
    return rounded(S.state_ratings(geo(spark, d), S.MIN_STATE_BUSINESSES, 10))


@query("state_rating_top15", f"""
select state, {r('avg(stars)')} as avg_stars, count(*) as business_count from geo_v group by state
order by round(avg(stars), 9) desc, state limit 15""", "geo_v")
def state_rating_top15(spark, d):
    return rounded(S.state_ratings(geo(spark, d), k=15))


@query("state_success", f"""
select state, count(business_id) as business_count, {r('avg(stars)')} as avg_stars, {r('avg(success)')} as success_rate
from analysis_v group by state order by business_count desc, state limit 10""", "analysis_v")
def state_success(spark, d):
    return rounded(S.state_success(D.chart_frame(analysis(spark, d), geo(spark, d), ["state"])))


FEATURES = ["review_count", "is_open", "has_wifi", "price_level", "noise_level", "avg_useful", "avg_funny", "avg_cool"]


@query("attribute_corr", " union all ".join(
    f"select '{f}' as feature, {r(f'corr({f}, stars)')} as correlation from analysis_v" for f in FEATURES), "analysis_v")
def attribute_corr(spark, d):
    return rounded(S.attribute_correlations(analysis(spark, d), FEATURES))


@query("hours_coverage", f"""
select count(*) filter (has_hours) as with_hours, count(*) as total, {r('count(*) filter (has_hours) / count(*)')} as share
from business_v""", "business_v")
def hours_coverage(spark, d):
    return rounded(H.hours_coverage(V.businesses(spark, d)))


@query("open_by_weekday", "select " + ", ".join(
    f"count(*) filter (business_id % {k} <> 0) as {day.lower()}_count" for day, k in V.CLOSED_EVERY.items())
    + " from business_v where has_hours", "business_v")
def open_by_weekday(spark, d):
    return H.open_by_weekday(V.businesses(spark, d))


_OPEN_DAYS = " + ".join(f"cast(business_id % {k} <> 0 as int)" for k in V.CLOSED_EVERY.values())


@query("rating_by_days_open", f"""
select cast({_OPEN_DAYS} as int) as days_open, {r('avg(stars)')} as avg_stars, count(*) as business_count
from business_v where has_hours group by 1""", "business_v")
def rating_by_days_open(spark, d):
    return rounded(H.rating_by_days_open(V.businesses(spark, d)))
