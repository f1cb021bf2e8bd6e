"""Histograms, densities, box statistics and scatter extracts."""

from pyspark.sql import functions as F

from venue_queries import views as V
from venue_queries.growth import metrics as growth_metrics
from venue_queries.profiles import analysis
from venue_queries.registry import query, r, rounded
from venuekit.functions.encode import clip, open_label, success_label, success_or_null
from venuekit.operators import distribution as X
from venuekit.operators.growth import clip_growth
from venuekit.plans import datasets as D


def _histogram_sql(expression, view, bins):
    return f"""
with v as (select cast({expression} as double) as v from {view}),
k as (select v from v where v is not null and not isnan(v)),
b as (select min(v) - case when min(v) = max(v) then 0.5 else 0 end as lo,
             max(v) + case when min(v) = max(v) then 0.5 else 0 end as hi from k),
c as (select cast(least(floor(round((v - lo) * {bins} / (hi - lo), 9)) + 1, {bins}) as int) as bin, count(*) as n from k, b group by 1)
select cast(i.bin as int) as bin, {r(f'lo + (hi - lo) / {bins} * (i.bin - 1)')} as bin_start,
       {r(f'lo + (hi - lo) / {bins} * i.bin')} as bin_end, coalesce(n, 0) as n
from range(1, {bins} + 1) i(bin) cross join b left join c on c.bin = i.bin"""


@query("hist_stars", _histogram_sql("stars", "business_v", 9), "business_v")
def hist_stars(spark, d):
    return rounded(X.histogram(V.businesses(spark, d), "stars", 9))


@query("hist_growth", _histogram_sql("avg_growth_rate", "clipped_v", 30), "clipped_v")
def hist_growth(spark, d):
    return rounded(X.histogram(clip_growth(growth_metrics(spark, d)), "avg_growth_rate", 30))


@query("hist_star_change", _histogram_sql("avg_star_change", "clipped_v", 30), "clipped_v")
def hist_star_change(spark, d):
    return rounded(X.histogram(clip_growth(growth_metrics(spark, d)), "avg_star_change", 30))


@query("hist_log_reviews", _histogram_sql("ln(1 + review_count)", "business_v", 30), "business_v")
def hist_log_reviews(spark, d):
    logged = V.businesses(spark, d).select(F.log1p("review_count").alias("log_review_count"))
    return rounded(X.histogram(logged, "log_review_count", 30))


@query("hist_log10_reviews", _histogram_sql(
    "case when review_count > 0 then log10(least(review_count, 1000)) end", "business_v", 30), "business_v")
def hist_log10_reviews(spark, d):
    # zero is outside a log axis
    logged = V.businesses(spark, d).filter(F.col("review_count") > 0).select(
        F.log10(clip("review_count", hi=1000)).alias("log10_review_count")
    )
    return rounded(X.histogram(logged, "log10_review_count", 30))


def _density_sql(expression, view):
    return f"""
with k as (select cast({expression} as double) as v from {view}),
s as (select count(*) as total, pow(count(*), -0.2) * stddev_samp(v) as h, min(v) as lo, max(v) as hi from k where v is not null),
f as (select v, count(*) as n from k where v is not null group by v),
p as (select i as point, lo + (hi - lo) / 199 * i as x, h, total from range(0, 200) g(i), s)
select cast(point as int) as point, {r('max(x)')} as x,
       {r('sum(n * exp(-0.5 * ((x - v) / h) * ((x - v) / h)) / (total * h * sqrt(2 * pi())))')} as density
from p cross join f group by point"""


@query("kde_stars", _density_sql("stars", "business_v"), "business_v")
def kde_stars(spark, d):
    return rounded(X.density_curve(V.businesses(spark, d), "stars"))


@query("kde_growth", _density_sql("avg_growth_rate", "clipped_v"), "clipped_v")
def kde_growth(spark, d):
    return rounded(X.density_curve(clip_growth(growth_metrics(spark, d)), "avg_growth_rate"))


@query("kde_star_change", _density_sql("avg_star_change", "clipped_v"), "clipped_v")
def kde_star_change(spark, d):
    return rounded(X.density_curve(clip_growth(growth_metrics(spark, d)), "avg_star_change"))


def _box_sql(group, value, view):
    return f"""
with k as (select {group} as g, cast({value} as double) as v from {view}),
q as (select g, count(*) as n, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median, quantile_cont(v, 0.75) as q3
      from k where g is not null and v is not null group by g)
select q.g as grp, any_value(q.n) as n, {r('any_value(q1)')} as q1, {r('any_value(median)')} as median, {r('any_value(q3)')} as q3,
       {r('min(v) filter (v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))')} as whisker_low,
       {r('max(v) filter (v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))')} as whisker_high,
       count(*) filter (v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)) as outliers
from k join q on k.g = q.g where v is not null group by q.g"""


@query("box_stars_status", _box_sql(
    "case is_open when 1 then 'Open' when 0 then 'Closed' end", "stars", "business_v"), "business_v")
def box_stars_status(spark, d):
    labelled = V.businesses(spark, d).select(open_label("is_open").alias("grp"), "stars")
    return rounded(X.box_stats(labelled, "stars", ["grp"]))


@query("box_reviews_success", _box_sql(
    "case success when 1 then 'Successful' when 0 then 'Not Successful' end", "review_count", "analysis_v"), "analysis_v")
def box_reviews_success(spark, d):
    labelled = analysis(spark, d).select(success_label("success").alias("grp"), "review_count")
    return rounded(X.box_stats(labelled, "review_count", ["grp"]))


@query("box_stars_wifi", _box_sql("has_wifi", "stars", "analysis_v"), "analysis_v")
def box_stars_wifi(spark, d):
    return rounded(X.box_stats(analysis(spark, d).select(F.col("has_wifi").alias("grp"), "stars"), "stars", ["grp"]))


@query("box_price_linestatus", _box_sql("l_linestatus", "l_extendedprice", "lineitem"))
def box_price_linestatus(spark, d):
    # many distinct values in two large groups
    lines = V.table(spark, d, "lineitem").select(F.col("l_linestatus").alias("grp"), "l_extendedprice")
    return rounded(X.box_stats(lines, "l_extendedprice", ["grp"]))


@query("scatter_growth", f"""
select business_id, {r('avg_star_change')} as avg_star_change, {r('avg_growth_rate')} as avg_growth_rate, stars
from clipped_v join business_v using (business_id)
where avg_star_change is not null and avg_growth_rate is not null""",
       "clipped_v", "business_v")
def scatter_growth(spark, d):
    joined = D.chart_frame(
        V.businesses(spark, d), clip_growth(growth_metrics(spark, d)), ["avg_star_change", "avg_growth_rate"]
    )
    return rounded(X.scatter_points(joined, "business_id", ["avg_star_change", "avg_growth_rate", "stars"]))


@query("scatter_reviews_stars", """
select business_id, review_count, stars, is_open, success from feature_v
where review_count is not null and stars is not null""", "feature_v")
def scatter_reviews_stars(spark, d):
    business = V.businesses(spark, d).select(
        "business_id", "review_count", "stars", F.col("is_open").cast("double").alias("is_open"),
        success_or_null("stars").alias("success"),
    )
    return X.scatter_points(business, "business_id", ["review_count", "stars", "is_open", "success"])


@query("scatter_bins", """
with b as (select min(review_count)::double as xl, max(review_count)::double as xh, min(stars) as yl, max(stars) as yh from business_v)
select cast(least(floor(round((review_count::double - xl) * 20 / (xh - xl), 9)) + 1, 20) as int) as x_bin,
       cast(least(floor(round((stars - yl) * 9 / (yh - yl), 9)) + 1, 9) as int) as y_bin, count(*) as n
from business_v, b where stars is not null and review_count is not null group by 1, 2""", "business_v")
def scatter_bins(spark, d):
    return X.scatter_bins(V.businesses(spark, d), "review_count", "stars", 20, 9)
