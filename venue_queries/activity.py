"""Calendar reports, check-ins, weekly profiles and text sentiment."""

from pyspark.sql import functions as F

from venue_queries import views as V
from venue_queries.growth import timed
from venue_queries.registry import query, r, rounded
from venuekit.functions.encode import success_or_null
from venuekit.functions.text import NEGATIVE, POSITIVE
from venuekit.operators import activity as A
from venuekit.operators import places as P
from venuekit.operators import reviews as R
from venuekit.plans import datasets as D
from venuekit.schema import WEEKDAYS
from venuekit.sinks.text import sentiment_line as to_line
from venuekit.sources.tables import corrupt_counts, valid_records

WEEK = list(WEEKDAYS)

# A second lexicon of words that are frequent in the supplied text.
COMMON_POSITIVE = ["the", "and"]
COMMON_NEGATIVE = ["of", "a", "hate"]


# ---- calendar ---------------------------------------------------------------------------------------------------

def _by(*parts):
    names = ", ".join(f"cast({fn}(date){' + 1' if fn == 'dayofweek' else ''} as int) as {name}" for fn, name in parts)
    keys = ", ".join(str(i + 1) for i in range(len(parts)))
    return f"select {names}, count(*) as review_count, {r('avg(stars)')} as avg_stars from review_v group by {keys}"


@query("reviews_by_year", _by(("year", "review_year")), "review_v")
def reviews_by_year(spark, d):
    return rounded(A.reviews_by(timed(spark, d), "review_year"))


@query("reviews_by_year_month", _by(("year", "review_year"), ("month", "review_month")), "review_v")
def reviews_by_year_month(spark, d):
    return rounded(A.reviews_by(timed(spark, d), "review_year", "review_month"))


@query("reviews_by_month", _by(("month", "review_month")), "review_v")
def reviews_by_month(spark, d):
    return rounded(A.reviews_by(timed(spark, d), "review_month"))


@query("reviews_by_dow", f"""
select cast(dayofweek(date) + 1 as int) as review_day, dayname(date) as day_name, count(*) as review_count,
       {r('avg(stars)')} as avg_stars from review_v group by 1, 2""", "review_v")
def reviews_by_dow(spark, d):
    return rounded(A.name_weekdays(A.reviews_by(timed(spark, d), "review_day"))).select(
        "review_day", "day_name", "review_count", "avg_stars"
    )


@query("reviews_by_hour", f"""
select cast(hour(ts) as int) as review_hour, count(*) as review_count, {r('avg(value)')} as avg_stars
from events group by 1""")
def reviews_by_hour(spark, d):
    # the events carry times of day; their value stands in for the stars
    events = A.review_times(V.table(spark, d, "events"), "ts")
    return rounded(A.reviews_by(events, "review_hour", stars="value"))


@query("calendar_rollup", f"""
select cast(month(date) as int) as review_month, cast(dayofweek(date) + 1 as int) as review_day, count(*) as review_count,
       {r('avg(stars)')} as avg_stars from review_v group by 1, 2""", "review_v")
def calendar_rollup(spark, d):
    return rounded(A.rollup_calendar(A.calendar_counts(timed(spark, d)), "review_month", "review_day"))


@query("review_time_parts", """
with p as (select review_id, case when review_id % 50 <> 0 then date end as ts from review_v)
select review_id, cast(year(ts) as int) as review_year, cast(month(ts) as int) as review_month,
       cast(dayofweek(ts) + 1 as int) as review_day, cast(hour(ts) as int) as review_hour from p""", "review_v")
def review_time_parts(spark, d):
    # dates as text, some of them with a 13th month
    text = F.date_format("date", "yyyy-MM-dd HH:mm:ss")
    bad = F.concat(F.year("date").cast("string"), F.lit("-13-40 00:00:00"))
    reviews = V.reviews(spark, d).select(
        "review_id", F.when(F.col("review_id") % 50 == 0, bad).otherwise(text).alias("date")
    )
    return A.review_times(reviews).drop("date")


# ---- check-ins and profiles -------------------------------------------------------------------------------------

_STAMPS = """
with s as (select business_id, unnest([t1, t2]) as ts, event_id % 3 + 1 as n from checkin_v)
select business_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as checkin_timestamp, cast({count} as int) as checkin_count,
       dayname(ts) as day_of_week, cast(hour(ts) as int) as hour_of_day from s"""


def checkin_list(spark, d):
    return V.checkin_stamps(spark, d).select("business_id", F.concat_ws(", ", "t1", "t2").alias("date"))


@query("checkin_expand", _STAMPS.format(count="1"), "checkin_v")
def checkin_expand(spark, d):
    return A.expand_checkins(checkin_list(spark, d))


@query("checkin_expand_map", _STAMPS.format(count="n"), "checkin_v")
def checkin_expand_map(spark, d):
    as_map = F.create_map("t1", "n", "t2", "n").alias("time")
    return A.expand_checkins(V.checkin_stamps(spark, d).select("business_id", as_map))


@query("checkin_expand_pairs", _STAMPS.format(count="n"), "checkin_v")
def checkin_expand_pairs(spark, d):
    pairs = F.array(*[F.struct(F.col(t).alias("_1"), F.col("n").alias("_2")) for t in ("t1", "t2")]).alias("time")
    return A.expand_checkins(V.checkin_stamps(spark, d).select("business_id", pairs))


@query("checkins_by_dow", """
with s as (select unnest([t1, t2]) as ts, event_id % 3 + 1 as n from checkin_v)
select dayname(ts) as day_of_week, count(*) as rows, cast(sum(n) as bigint) as weighted from s group by 1""", "checkin_v")
def checkins_by_dow(spark, d):
    as_map = F.create_map("t1", "n", "t2", "n").alias("time")
    return A.checkins_by_weekday(A.expand_checkins(V.checkin_stamps(spark, d).select("business_id", as_map)))


def routed(spark, d):
    return A.route_activity(V.activity(spark, d))


@query("route_activity", "select * from routed_v", "routed_v")
def route_activity(spark, d):
    return routed(spark, d)


def activity_lines(spark, d):
    """Events as mixed JSON lines: purchases carry a date, views a time map, the rest neither.

    Every 40th line is cut short and every 30th date has a 13th month.
    """
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    number = F.col("event_id")
    bad = F.concat(F.year("ts").cast("string"), F.lit("-13-01 00:00:00"))
    date = F.when(F.col("event_type") == "purchase", F.when(number % 30 == 0, bad).otherwise(at))
    time = F.when(F.col("event_type") == "view", F.create_map(at, number % 3 + 1))
    line = F.to_json(F.struct(F.col("user_id").cast("string").alias("business_id"), date.alias("date"), time.alias("time")))
    cut = F.substring(line, 1, 12)
    return V.table(spark, d, "events").select(F.when(number % 40 == 0, cut).otherwise(line).alias("value"))


@query("activity_corrupt_counts", """
select case when event_id % 40 = 0 then 'parse_error' else 'bad_date' end as reason, count(*) as n from events
where event_id % 40 = 0 or (event_id % 30 = 0 and event_type = 'purchase') group by 1""")
def activity_corrupt_counts(spark, d):
    return corrupt_counts(A.check_activity(activity_lines(spark, d)))


@query("route_records", """
select user_id::varchar as business_id, case event_type when 'purchase' then 'review' else 'checkin' end as kind,
       dayname(ts) as day_of_week, cast(hour(ts) as int) as hour_of_day,
       case event_type when 'purchase' then 1 else event_id % 3 + 1 end as weight
from events where event_id % 40 <> 0 and (event_type = 'view' or (event_type = 'purchase' and event_id % 30 <> 0))""")
def route_records(spark, d):
    return A.route_records(valid_records(A.check_activity(activity_lines(spark, d))))


_SLOTS = ", ".join(f"('day', '{day}')" for day in WEEK) + ", " + ", ".join(f"('hour', '{h:02d}')" for h in range(24))


@query("temporal_profile_long", f"""
select b.business_id, s.unit, s.slot,
       count(*) filter (r.kind = 'review') as reviews, count(*) filter (r.kind = 'checkin') as checkins
from (select distinct business_id from routed_v) b cross join (values {_SLOTS}) as s(unit, slot)
left join routed_v r on r.business_id = b.business_id
  and case s.unit when 'day' then r.day_of_week = s.slot else lpad(r.hour_of_day::varchar, 2, '0') = s.slot end
group by 1, 2, 3""", "routed_v")
def temporal_profile_long(spark, d):
    return A.temporal_profile_long(A.temporal_profile(routed(spark, d)))


def _cell(slot, condition):
    return (f"'{slot}:' || count(*) filter (kind = 'review' and {condition}) || '/' "
            f"|| count(*) filter (kind = 'checkin' and {condition})")


_DAYS = " || ',' || ".join(_cell(day, f"day_of_week = '{day}'") for day in WEEK)
_HOURS = " || ',' || ".join(_cell(f"{h:02d}", f"hour_of_day = {h}") for h in range(24))


@query("temporal_profile", f"""
select business_id, 'day_profile:' || {_DAYS} || '|hour_profile:' || {_HOURS} as line from routed_v group by business_id""",
       "routed_v")
def temporal_profile(spark, d):
    return A.profile_line(A.temporal_profile(routed(spark, d)))


@query("temporal_profile_weighted", """
with a as (
  select business_id, 'review' as kind, date as ts, 1 as w from activity_v where date is not null
  union all
  select business_id, 'checkin', unnest([t1, t2]), event_id % 3 + 1 from checkin_v),
p as (select business_id, dayname(ts) as slot, cast(sum(w) filter (kind = 'review') as bigint) as reviews,
             cast(sum(w) filter (kind = 'checkin') as bigint) as checkins from a group by 1, 2)
select business_id, slot, coalesce(reviews, 0) as reviews, coalesce(checkins, 0) as checkins from p""",
       "activity_v", "checkin_v")
def temporal_profile_weighted(spark, d):
    dated = V.activity(spark, d).filter(F.col("date").isNotNull())
    as_map = F.create_map("t1", "n", "t2", "n").alias("time")
    rows = A.expand_checkins(V.checkin_stamps(spark, d).select("business_id", as_map))
    profile = A.temporal_profile(A.activity_from(dated, rows), weight="weight")
    days = A.temporal_profile_long(profile).filter(F.col("unit") == "day").drop("unit")
    return days.filter((F.col("reviews") > 0) | (F.col("checkins") > 0))


# ---- sentiment --------------------------------------------------------------------------------------------------

def sentiment_sql(positive=POSITIVE, negative=NEGATIVE):
    """The score in SQL."""
    def hits(words):
        return " + ".join(f"cast(contains(lower(text), '{w}') as int)" for w in words)

    p, n = f"({hits(positive)})", f"({hits(negative)})"
    return f"case when {p} + {n} = 0 then 0.0::double else ({p} - {n})::double / ({p} + {n}) end"


UTF16 = "(length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')))"


def _scored(view, positive=POSITIVE, negative=NEGATIVE, keep=""):
    return (f"select business_id, user_id, {keep} cast(trunc(stars) as int) as stars, "
            f"{sentiment_sql(positive, negative)} as sentiment, cast({UTF16} as int) as text_length from {view}")


_ROLLUP = f"""
with scored as ({{scored}})
select business_id, count(*) as total_reviews, {r('avg(stars)')} as avg_stars, {r('avg(sentiment)')} as avg_sentiment,
       {r('avg(text_length)')} as avg_text_length, count(distinct user_id) as unique_users
from scored group by business_id"""


@query("sentiment_score", f"select business_id, user_id, doc_id, stars, {r('sentiment')} as sentiment, text_length from ("
       + _scored("text_v", keep="doc_id,") + ")", "text_v")
def sentiment_score(spark, d):
    return rounded(R.score_reviews(V.text_reviews(spark, d), keep=["doc_id"]))


@query("sentiment_common_words", f"select doc_id, {r('sentiment')} as sentiment from ("
       + _scored("text_v", COMMON_POSITIVE, COMMON_NEGATIVE, keep="doc_id,") + ")", "text_v")
def sentiment_common_words(spark, d):
    scored = R.score_reviews(V.text_reviews(spark, d), COMMON_POSITIVE, COMMON_NEGATIVE, keep=["doc_id"])
    return rounded(scored.select("doc_id", "sentiment"))


def _token_hits(words):
    return " + ".join(f"cast(list_contains(tokens, '{w}') as int)" for w in words)


@query("sentiment_token", f"""
with t as (select doc_id, regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') as tokens from text_v),
h as (select doc_id, {_token_hits(COMMON_POSITIVE)} as p, {_token_hits(COMMON_NEGATIVE)} as n from t)
select doc_id, {r("case when p + n = 0 then 0.0 else (p - n)::double / (p + n) end")} as sentiment from h""", "text_v")
def sentiment_token(spark, d):
    scored = R.score_reviews(
        V.text_reviews(spark, d), COMMON_POSITIVE, COMMON_NEGATIVE, mode="token", keep=["doc_id"]
    )
    return rounded(scored.select("doc_id", "sentiment"))


@query("sentiment_by_business", _ROLLUP.format(scored=_scored("text_v")), "text_v")
def sentiment_by_business(spark, d):
    return rounded(R.sentiment_rollup(R.score_reviews(V.text_reviews(spark, d))))


def _two(expression):
    return f"cast(cast(round(cast({expression} as decimal(30, 10)), 2) as decimal(18, 2)) as varchar)"


@query("sentiment_line", f"""
with scored as ({_scored('text_v')})
select business_id, concat_ws('|', count(*)::varchar, {_two('avg(stars)')}, {_two('avg(sentiment)')},
       {_two('avg(text_length)')}, count(distinct user_id)::varchar) as line from scored group by business_id""", "text_v")
def sentiment_line(spark, d):
    return to_line(R.sentiment_rollup(R.score_reviews(V.text_reviews(spark, d))))


@query("sentiment_by_month", f"""
with s as (select cast(1 + doc_id % 12 as int) as review_month, {sentiment_sql()} as sentiment from text_v)
select review_month, count(*) as review_count, {r('avg(sentiment)')} as avg_sentiment from s group by 1""", "text_v")
def sentiment_by_month(spark, d):
    # the documents carry no date: their number gives the month
    dated = V.text_reviews(spark, d).withColumn(
        "date", F.format_string("2020-%02d-01 00:00:00", 1 + F.col("doc_id") % 12)
    )
    scored = R.score_reviews(A.review_times(dated), keep=["review_month"])
    return rounded(A.sentiment_by_month(scored))


_PLACE_SENTIMENT = f"""place_sentiment as (
  select business_id, count(*) as total_reviews, avg(sentiment) as avg_sentiment
  from ({_scored('place_text_v')}) group by business_id)"""


def place_sentiment(spark, d):
    return R.sentiment_rollup(R.score_reviews(V.place_text_reviews(spark, d)))


@query("analysis_with_sentiment", f"""
with {_PLACE_SENTIMENT}
select business_id, stars, {r('avg_review_stars')} as avg_review_stars, {r('coalesce(avg_sentiment, 0.0)')} as avg_sentiment
from analysis_v left join place_sentiment using (business_id)""", "analysis_v", "place_text_v")
def analysis_with_sentiment(spark, d):
    data = D.analysis_from(V.businesses(spark, d), V.reviews(spark, d), place_sentiment(spark, d))
    return rounded(data.select("business_id", "stars", "avg_review_stars", "avg_sentiment"))


@query("density_sentiment", f"""
with {_PLACE_SENTIMENT}
select postal_code, city, state, count(business_id) as business_count, cast(sum(total_reviews) as bigint) as scored_reviews,
       {r('sum(avg_sentiment * total_reviews) / sum(total_reviews)')} as avg_sentiment
from geo_v left join place_sentiment using (business_id) group by 1, 2, 3""", "geo_v", "place_text_v")
def density_sentiment(spark, d):
    geo = D.geo_dataset(V.businesses(spark, d), R.review_averages(V.reviews(spark, d)))
    return rounded(P.density_sentiment(geo, place_sentiment(spark, d)))


@query("category_profile", f"""
with {_PLACE_SENTIMENT},
e as (select unnest(string_split(categories, ', ')) as category, stars, success, avg_sentiment
      from feature_v left join place_sentiment using (business_id))
select category, count(*) as business_count, {r('avg(stars)')} as avg_stars, {r('avg(success)')} as success_rate,
       {r('avg(avg_sentiment)')} as avg_sentiment from e group by category""", "feature_v", "place_text_v")
def category_profile(spark, d):
    business = V.businesses(spark, d).withColumn("success", success_or_null("stars"))
    return rounded(P.category_profile(business, place_sentiment(spark, d)))
