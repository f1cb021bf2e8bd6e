"""Year-over-year growth."""

from venue_queries import views as V
from venue_queries.registry import query, r, rounded
from venuekit.operators import activity as A
from venuekit.operators import forecast as P
from venuekit.operators import growth as G


def timed(spark, d):
    return A.review_times(V.reviews(spark, d))


def yearly(spark, d):
    return G.yearly_reviews(timed(spark, d))


def pairs(spark, d):
    return G.year_pairs(yearly(spark, d))


def metrics(spark, d):
    return G.growth_metrics(pairs(spark, d))


@query("growth_by_business", f"""
select business_id, {r('avg_growth_rate')} as avg_growth_rate, {r('avg_star_change')} as avg_star_change, years_with_data
from growth_v""", "growth_v")
def growth_by_business(spark, d):
    return rounded(metrics(spark, d))


@query("yearly_reviews", f"""
select business_id, cast(review_year as int) as review_year, yearly_reviews, {r('yearly_avg_stars')} as yearly_avg_stars
from yearly_v""", "yearly_v")
def yearly_reviews(spark, d):
    return rounded(yearly(spark, d))


_PAIR = f"""business_id, cast(year1 as int) as year1, reviews1, cast(year2 as int) as year2, reviews2, review_growth,
{r('growth_rate')} as growth_rate, {r('stars1')} as stars1, {r('stars2')} as stars2, {r('star_change')} as star_change"""


@query("review_growth", f"select {_PAIR} from pair_v", "pair_v")
def review_growth(spark, d):
    return rounded(pairs(spark, d))


@query("growth_top10", f"""
select {_PAIR} from (select * from pair_v order by growth_rate desc, business_id, year1 limit 10)""", "pair_v")
def growth_top10(spark, d):
    return rounded(G.extreme_growth(pairs(spark, d), 10, top=True))


@query("growth_bottom10", f"""
select {_PAIR} from (select * from pair_v order by growth_rate, business_id, year1 limit 10)""", "pair_v")
def growth_bottom10(spark, d):
    return rounded(G.extreme_growth(pairs(spark, d), 10, top=False))


@query("clip_growth", f"""
select business_id, {r('avg_growth_rate')} as avg_growth_rate, {r('avg_star_change')} as avg_star_change, years_with_data
from clipped_v""", "clipped_v")
def clip_growth(spark, d):
    return rounded(G.clip_growth(metrics(spark, d)))


@query("growth_rating_corr", f"""
with c as (select corr(avg_star_change, avg_growth_rate) as correlation from clipped_v)
select {r('correlation')} as correlation,
       case when correlation is null or isnan(correlation) then 'undefined' when correlation > 0.5 then 'strong positive'
            when correlation > 0.3 then 'moderate positive' when correlation > 0.1 then 'weak positive'
            when correlation > -0.1 then 'none' else 'negative' end as strength
from c""", "clipped_v")
def growth_rating_corr(spark, d):
    return rounded(G.growth_rating_correlation(metrics(spark, d)))


@query("volume_trend", f"""
select business_id, {r('regr_slope(yearly_reviews, review_year)')} as slope, count(*) as years
from yearly_v group by business_id having count(*) >= 2""", "yearly_v")
def volume_trend(spark, d):
    return rounded(G.volume_trend(yearly(spark, d)))


# The fold as a recursion: one step a month, the state in a row.
_SMOOTH = f"""
m as (
    select business_id, cast(12 * year(date) + month(date) - 1 as int) as month, count(*) as n
    from (select business_id, cast(date as timestamp) as date from review_v) group by 1, 2
), b as (
    select business_id, min(month) as first, (select max(month) from m) as stop from m group by business_id
), g as (
    select business_id, stop, month - first as i, stop - first + 1 as months, cast(coalesce(n, 0) as double) as x
    from (select *, unnest(range(first, stop + 1)) as month from b) left join m using (business_id, month)
), s as (
    select business_id, stop, months, if(months >= 24, months - 12, months) as fitted, array_agg(x order by i) as x from g group by all
), a as (
    select *, least(fitted, 12) as done, list_sum(x[1:least(fitted, 12)]) / least(fitted, 12) as mean from s
), w as (
    select business_id, stop, months, fitted, x, done, mean as level, 0.0::double as trend,
           [if(fitted >= 12, x[i] - mean, 0.0::double) for i in range(1, 13)] as season from a
    union all
    select business_id, stop, months, fitted, x, done + 1, base, {P.TREND} * (base - level) + {1 - P.TREND} * trend,
           [if(i = done % 12 + 1, {P.SEASONAL} * (x[done + 1] - base) + {1 - P.SEASONAL} * season[i], season[i]) for i in range(1, 13)]
    from (select *, {P.LEVEL} * (x[done + 1] - season[done % 12 + 1]) + {1 - P.LEVEL} * (level + trend) as base
          from w where done < months)
), e as (
    select business_id, avg(abs(x[done + h] - greatest(level + h * trend + season[(done + h - 1) % 12 + 1], 0))) as held_error
    from w, range(1, 13) r(h) where done = fitted and months > fitted group by business_id
)"""


@query("volume_forecast", f"""
with recursive {_SMOOTH}
select business_id, cast((stop + h) // 12 as int) as year, cast((stop + h) % 12 + 1 as int) as month,
       {r('greatest(level + h * trend + season[(done + h - 1) % 12 + 1], 0)')} as expected, cast(months as int) as months,
       {r('held_error')} as held_error
from w left join e using (business_id), range(1, 13) q(h) where done = months""", "review_v")
def volume_forecast(spark, d):
    return rounded(P.volume_forecast(timed(spark, d)))
