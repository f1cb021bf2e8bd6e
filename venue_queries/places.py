"""Directory, regional profiles and map extracts."""

from pyspark.sql import functions as F

from venue_queries import views as V
from venue_queries.io import geo
from venue_queries.registry import query, r, rounded
from venuekit.functions.hashing import unit_hash
from venuekit.operators import clusters as Q
from venuekit.operators import places as P
from venuekit.operators import reviews as R
from venuekit.operators import sampling as SM
from venuekit.operators import selection as SE
from venuekit.session import new_path
from venuekit.sinks import tables as K


@query("review_votes", f"""
select business_id, {r('avg_review_stars')} as avg_review_stars, {r('avg_useful')} as avg_useful, {r('avg_funny')} as avg_funny,
       {r('avg_cool')} as avg_cool from votes_v""", "votes_v")
def review_votes(spark, d):
    return rounded(R.review_votes(V.reviews(spark, d)))


@query("review_avg2", f"""
select business_id, {r('avg_review_stars')} as avg_stars, {r('avg_useful')} as avg_useful from votes_v""", "votes_v")
def review_avg2(spark, d):
    return rounded(R.review_averages(V.reviews(spark, d)))


@query("review_summary", f"""
select business_id, count(*) as review_count, {r('avg(stars)')} as avg_review_stars from review_v group by business_id""",
       "review_v")
def review_summary(spark, d):
    return rounded(R.review_summary(V.reviews(spark, d)))


_DIRECTORY = """
select state || ':' || city as location, business_id, name,
       coalesce(string_split(categories, ', ')[1], 'uncategorized') as main_category, stars, review_count from business_v"""


@query("location_directory", _DIRECTORY, "business_v")
def location_directory(spark, d):
    return P.location_directory(V.businesses(spark, d))


@query("directory_lines", f"""
select location || chr(9) || business_id || '|' || name || '|' || main_category || '|' || stars || '|' || review_count as value
from ({_DIRECTORY})""", "business_v")
def directory_lines(spark, d):
    path = new_path(spark, "directory")
    lines = P.directory_line(P.location_directory(V.businesses(spark, d)))
    K.write_grouped_lines(lines, path, "location", "business_id")
    return spark.read.text(path)


@query("geo_dataset", f"""
select business_id, name, stars, review_count, is_open, categories, latitude, longitude, city, state, postal_code,
       {r('avg_stars')} as avg_stars, {r('avg_useful')} as avg_useful from geo_v""", "geo_v")
def geo_dataset(spark, d):
    return rounded(geo(spark, d))


@query("count_by_state", """
select state, count(*) as business_count from business_v group by state order by business_count desc, state limit 10""",
       "business_v")
def count_by_state(spark, d):
    return P.top_counts(V.businesses(spark, d), "state", k=P.TOP_STATES)


@query("count_by_city", """
select city, state, count(*) as business_count from business_v group by city, state
order by business_count desc, city, state limit 20""", "business_v")
def count_by_city(spark, d):
    return P.top_counts(V.businesses(spark, d), "city", "state", k=P.TOP_CITIES)


@query("top_states", """
select state, count(*) as business_count from geo_v where state is not null group by state order by business_count desc, state limit 15""", "geo_v")
def top_states(spark, d):
    return P.top_counts(geo(spark, d), "state", k=15, keep_null=False)


@query("postal_density", f"""
select postal_code, city, state, count(business_id) as business_count, {r('avg(stars)')} as avg_business_stars,
       {r('avg(avg_stars)')} as avg_review_stars, {r('avg(review_count)')} as avg_review_count
from geo_v group by 1, 2, 3 order by business_count desc, 1, 2, 3 limit 20""", "geo_v")
def postal_density(spark, d):
    return rounded(P.postal_density(geo(spark, d)))


@query("state_profile", f"""
select state, count(business_id) as business_count, {r('avg(stars)')} as avg_business_stars,
       {r('stddev_samp(stars)')} as stddev_stars, {r('avg(avg_stars)')} as avg_review_stars,
       {r('avg(review_count)')} as avg_review_count, {r('quantile_disc(stars, 0.5)')} as median_stars
from geo_v group by state""", "geo_v")
def state_profile(spark, d):
    return rounded(P.state_profile(geo(spark, d)))


@query("top_state_places", """
select business_id, state, city, stars from geo_v where state in (
  select state from geo_v group by state order by count(*) desc, state limit 10)""", "geo_v")
def top_state_places(spark, d):
    return P.top_state_places(geo(spark, d)).select("business_id", "state", "city", "stars")


_U = "cast('0x' || substr(md5('{seed}:' || {key}), 1, 8) as bigint) / 4294967296.0"
_MD5 = "md5('42:' || business_id)"


@query("map_sample", f"""
select business_id, state, stars from geo_v where {_U.format(seed=42, key='business_id')} < 0.1
order by {_MD5}, business_id limit 5000""", "geo_v")
def map_sample(spark, d):
    return P.map_sample(geo(spark, d)).select("business_id", "state", "stars")


@query("map_points", f"""
select business_id, latitude, longitude,
       case when stars >= 4.5 then 'darkgreen' when stars >= 4.0 then 'green' when stars >= 3.0 then 'orange' else 'red' end as color,
       name || chr(10) || 'Stars: ' || stars || chr(10) || 'Reviews: ' || review_count || chr(10)
       || 'City: ' || city || ', ' || state as label
from (select * from geo_v order by {_MD5}, business_id limit 1000) where latitude is not null and longitude is not null""",
       "geo_v")
def map_points(spark, d):
    return P.map_points(geo(spark, d))


@query("map_centroid", f"""
select {r('avg(latitude)')} as center_lat, {r('avg(longitude)')} as center_lon
from (select * from geo_v order by {_MD5}, business_id limit 1000)""", "geo_v")
def map_centroid(spark, d):
    return rounded(P.map_centroid(P.plotted_points(geo(spark, d))))


@query("hash_split", f"""
select l_orderkey, l_linenumber, {_U.format(seed=42, key='l_orderkey')} < 0.8 as is_train from lineitem""")
def hash_split(spark, d):
    lines = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return SM.with_split(lines, "l_orderkey", 0.8)


@query("unit_hash", f"""
select event_id, {r(_U.format(seed=7, key='event_id'))} as u from events""")
def unit_hash_values(spark, d):
    return rounded(V.table(spark, d, "events").select("event_id", unit_hash(F.col("event_id"), 7).alias("u")))


@query("sample_exact", """
select business_id, state from (
    select *, row_number() over (order by md5('42:' || business_id)) as place, count(*) over () as n from geo_v
) where place <= floor(n * 0.25)""", "geo_v")
def sample_exact(spark, d):
    return SE.sample_exactly(geo(spark, d).select("business_id", "state"), "business_id", share=0.25)


@query("map_clusters", f"""
with p as (
    select *, least(greatest(floor((longitude + 180.0) / 360.0 * 4096), 0), 4095)::bigint as x,
           least(greatest(floor((latitude + 90.0) / 180.0 * 4096), 0), 4095)::bigint as y
    from business_v where latitude is not null and longitude is not null
), l as (
    select *, level, [(x >> (12 - level)) >> i & 1 for i in range(12)] as xs, [(y >> (12 - level)) >> i & 1 for i in range(12)] as ys
    from p, range(13) r(level)
), c as (
    select *, list_sum([(xs[i] << (2 * i - 2)) + (ys[i] << (2 * i - 1)) for i in range(1, 13)]) as cell from l
)
select cast(level as int) as level, cast(cell as bigint) as cell, count(*) as n, {r('avg(latitude)')} as center_lat,
       {r('avg(longitude)')} as center_lon, {r('avg(stars)')} as avg_stars, count(*) filter (is_open = 1) as n_open
from c group by level, cell""", "business_v")
def map_clusters(spark, d):
    return rounded(Q.map_clusters(V.businesses(spark, d)))
