"""The venue tables, bound to the supplied parquet tables: once as Spark frames, once as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuekit.schema import WEEKDAYS

# A business has no entry for a weekday when its number divides by this (Monday first).
CLOSED_EVERY = dict(zip(WEEKDAYS, [2, 3, 4, 5, 6, 7, 9]))

SQL: dict[str, str] = {
    "business_v": """
select c_custkey as business_id, c_name as name,
       cast(1.0 + 0.5 * least(floor((c_acctbal + 1000.0) / 1222.2), 8) as double) as stars,
       coalesce(n_orders, 0) as review_count,
       case when c_custkey % 10 < 7 then 1 else 0 end as is_open,
       case when c_custkey % 11 = 0 then null else concat(c_mktsegment, ', ', r_name) end as categories,
       case c_custkey % 5 when 0 then 'free' when 1 then '''paid''' when 2 then 'u''free''' when 3 then 'no' end as attr_wifi,
       case c_custkey % 6 when 0 then 'None' when 5 then null else cast(c_custkey % 6 as varchar) end as attr_price,
       case c_custkey % 7 when 0 then 'quiet' when 1 then '''average''' when 2 then 'loud' when 3 then 'very_loud' when 4 then 'unknown' end as attr_noise,
       case c_custkey % 4 when 0 then 'True' when 1 then '''True''' when 2 then 'False' end as attr_credit,
       case c_custkey % 3 when 0 then 'true' when 1 then '''False''' end as attr_reserve,
       cast(case when c_custkey % 13 = 0 then null when c_custkey % 17 = 0 then 0.0 else 24.0 + n_nationkey end as double) as latitude,
       cast(case when c_custkey % 13 = 0 then null else -120.0 + 2 * n_nationkey end as double) as longitude,
       concat('City_', cast(c_custkey % 40 as varchar)) as city, n_name as state,
       cast(10000 + c_custkey % 200 as varchar) as postal_code,
       c_custkey % 8 <> 0 as has_hours
from customer
join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
left join (select o_custkey, count(*) as n_orders from orders group by o_custkey) o on o_custkey = c_custkey""",
    "feature_v": """
select business_id, name, stars, review_count, cast(is_open as double) as is_open, categories, latitude, longitude,
       city, state, postal_code,
       case when attr_wifi in ('free', '''free''') then 2.0::double when attr_wifi in ('paid', '''paid''') then 1.0::double else 0.0::double end as has_wifi,
       coalesce(try_cast(attr_price as double), 0.0::double) as price_level,
       case when attr_noise in ('quiet', '''quiet''') then 1.0::double when attr_noise in ('average', '''average''') then 2.0::double
            when attr_noise in ('loud', '''loud''') then 3.0::double when attr_noise in ('very_loud', '''very_loud''') then 4.0::double else 2.0::double end as noise_level,
       case when attr_credit in ('true', 'True', '''true''', '''True''') then 1.0::double else 0.0::double end as takes_credit_cards,
       case when attr_reserve in ('true', 'True', '''true''', '''True''') then 1.0::double else 0.0::double end as takes_reservations,
       case when attr_wifi in ('free', '''free''') then 1.0::double when attr_wifi in ('paid', '''paid''') then 0.5::double else 0.0::double end as wifi_share,
       cast(stars >= 4.0 as double) as success
from business_v""",
    "review_v": """
select o_orderkey as review_id, o_custkey as business_id, o_orderkey % 997 as user_id,
       cast(substr(o_orderpriority, 1, 1) as int) as stars,
       o_orderkey % 7 as useful, o_orderkey % 5 as funny, o_orderkey % 3 as cool, o_orderdate as date
from orders""",
    "votes_v": """
select business_id, avg(stars) as avg_review_stars, avg(useful) as avg_useful, avg(funny) as avg_funny, avg(cool) as avg_cool
from review_v group by business_id""",
    "analysis_v": """
select f.*, avg_review_stars, avg_useful, avg_funny, avg_cool from feature_v f join votes_v using (business_id)""",
    "geo_v": """
select business_id, name, stars, review_count, is_open, categories, latitude, longitude, city, state, postal_code,
       avg_review_stars as avg_stars, avg_useful
from business_v join votes_v using (business_id)""",
    "yearly_v": """
select business_id, year(date) as review_year, count(*) as yearly_reviews, avg(stars) as yearly_avg_stars
from review_v group by business_id, year(date)""",
    "pair_v": """
select a.business_id, a.review_year as year1, a.yearly_reviews as reviews1, b.review_year as year2,
       b.yearly_reviews as reviews2, b.yearly_reviews - a.yearly_reviews as review_growth,
       (b.yearly_reviews - a.yearly_reviews) / a.yearly_reviews as growth_rate,
       a.yearly_avg_stars as stars1, b.yearly_avg_stars as stars2,
       b.yearly_avg_stars - a.yearly_avg_stars as star_change
from yearly_v a join yearly_v b on a.business_id = b.business_id and a.review_year + 1 = b.review_year""",
    "growth_v": """
select business_id, avg(growth_rate) as avg_growth_rate, avg(star_change) as avg_star_change, count(*) as years_with_data
from pair_v group by business_id""",
    "clipped_v": """
select business_id, least(greatest(avg_growth_rate, -1.0), 2.0) as avg_growth_rate,
       least(greatest(avg_star_change, -1.0), 1.0) as avg_star_change, years_with_data
from growth_v""",
    "activity_v": """
select user_id as business_id, case when event_type = 'purchase' then ts end as date,
       case when event_type = 'view' then ts end as time
from events""",
    "routed_v": """
select business_id, case when date is not null then 'review' else 'checkin' end as kind,
       dayname(coalesce(date, time)) as day_of_week, cast(hour(coalesce(date, time)) as int) as hour_of_day
from activity_v where date is not null or time is not null""",
    "checkin_v": """
select user_id as business_id, ts as t1, ts + interval 5 hour as t2, event_id from events""",
    "text_v": """
select source as business_id, lang as user_id, cast(1 + doc_id % 5 as double) + 0.7 as stars, text, doc_id from documents""",
    "place_text_v": """
select doc_id // 3 as business_id, lang as user_id, cast(1 + doc_id % 5 as double) as stars, text from documents""",
    "state_rank_v": """
select state, cast(row_number() over (order by count(*) desc, state) - 1 as double) as state_idx
from geo_v where state is not null group by state""",
    "model_v": """
select business_id, coalesce(stars, 0.0) as stars, coalesce(cast(review_count as double), 0.0) as review_count,
       coalesce(is_open, 0.0) as is_open, case when stars >= 4.0 then 1.0::double else 0.0::double end as success,
       has_wifi, state_idx, coalesce(avg_growth_rate, 0.0) as avg_growth_rate,
       coalesce(avg_star_change, 0.0) as avg_star_change,
       coalesce(cast(years_with_data as double), 0.0) as years_with_data
from analysis_v join state_rank_v using (state) left join growth_v using (business_id)""",
}

_NEEDS = {
    "feature_v": ["business_v"], "votes_v": ["review_v"], "analysis_v": ["feature_v", "votes_v"],
    "geo_v": ["business_v", "votes_v"], "yearly_v": ["review_v"], "pair_v": ["yearly_v"], "growth_v": ["pair_v"],
    "clipped_v": ["growth_v"], "routed_v": ["activity_v"], "state_rank_v": ["geo_v"],
    "model_v": ["analysis_v", "state_rank_v", "growth_v"],
}


def with_views(body: str, *names: str) -> str:
    """``body`` with the named views, and those they need, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    views = ",\n".join(f"{name} as ({SQL[name].strip()}\n)" for name in ordered)
    body = body.strip()
    start = "with recursive" if body.lower().startswith("with recursive ") else "with"
    joiner = ",\n" + body[len(start) + 1 :] if body.lower().startswith("with ") else "\n" + body
    return f"{start} {views}{joiner}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cycle(n: int, *values: str | None):
    """The value at the business number modulo ``n``; missing positions are null."""
    position = F.col("business_id") % n
    out = F.when(position == 0, F.lit(values[0]))
    for i, value in enumerate(values[1:], 1):
        out = out.when(position == i, F.lit(value))
    return out


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as businesses in the canonical flat shape (struct attributes and hours)."""
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(counts, F.col("o_custkey") == F.col("c_custkey"), "left")
        .withColumn("business_id", F.col("c_custkey"))
    )
    key = F.col("business_id")
    hours = F.struct(
        *[F.when(key % every != 0, "9:0-17:0").alias(day) for day, every in CLOSED_EVERY.items()]
    )
    attributes = F.struct(
        _cycle(5, "free", "'paid'", "u'free'", "no").alias("WiFi"),
        F.when(key % 6 == 0, "None").when(key % 6 != 5, (key % 6).cast("string")).alias("RestaurantsPriceRange2"),
        _cycle(7, "quiet", "'average'", "loud", "very_loud", "unknown").alias("NoiseLevel"),
        _cycle(4, "True", "'True'", "False").alias("BusinessAcceptsCreditCards"),
        _cycle(3, "true", "'False'").alias("RestaurantsReservations"),
    )
    return places.select(
        "business_id",
        F.col("c_name").alias("name"),
        (1.0 + 0.5 * F.least(F.floor((F.col("c_acctbal") + 1000.0) / 1222.2), F.lit(8))).cast("double").alias("stars"),
        F.coalesce("n_orders", F.lit(0)).alias("review_count"),
        F.when(key % 10 < 7, 1).otherwise(0).alias("is_open"),
        F.when(key % 11 != 0, F.concat_ws(", ", "c_mktsegment", "r_name")).alias("categories"),
        attributes.alias("attributes"),
        F.when(key % 13 != 0, F.when(key % 17 == 0, 0.0).otherwise(24.0 + F.col("n_nationkey"))).alias("latitude"),
        F.when(key % 13 != 0, -120.0 + 2 * F.col("n_nationkey")).cast("double").alias("longitude"),
        F.concat(F.lit("City_"), (key % 40).cast("string")).alias("city"),
        F.col("n_name").alias("state"),
        (10000 + key % 200).cast("string").alias("postal_code"),
        F.when(key % 8 != 0, hours).alias("hours"),
    ).withColumn("category_array", F.split("categories", ", "))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reviews, dated."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("review_id"),
        F.col("o_custkey").alias("business_id"),
        (key % 997).alias("user_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("stars"),
        (key % 7).alias("useful"),
        (key % 5).alias("funny"),
        (key % 3).alias("cool"),
        F.col("o_orderdate").alias("date"),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as mixed activity records: purchases are reviews, views are check-ins, the rest is neither."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("business_id"),
        F.when(F.col("event_type") == "purchase", F.col("ts")).alias("date"),
        F.when(F.col("event_type") == "view", F.col("ts")).alias("time"),
    )


def checkin_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as check-in records with two stamps each, as text."""
    ts = F.col("ts")

    def text(stamp):
        return F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")

    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("business_id"),
        text(ts).alias("t1"),
        text(ts + F.expr("interval 5 hours")).alias("t2"),
        (F.col("event_id") % 3 + 1).alias("n"),
    )


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews of few, very popular businesses."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("business_id"),
        F.col("lang").alias("user_id"),
        ((1 + F.col("doc_id") % 5).cast("double") + 0.7).alias("stars"),
        "text",
        "doc_id",
    )


def place_text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews of the customers, three each."""
    return table(spark, sf_dir, "documents").select(
        F.floor(F.col("doc_id") / 3).alias("business_id"),
        F.col("lang").alias("user_id"),
        (1 + F.col("doc_id") % 5).cast("double").alias("stars"),
        "text",
    )
