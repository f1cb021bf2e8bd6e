"""Readers and writers, fed with files that Spark derives from the supplied tables."""

from pyspark.sql import functions as F

from venue_queries import views as V
from venue_queries.registry import query, r, rounded
from venuekit import schema as S
from venuekit.operators import places as P
from venuekit.operators import reviews as R
from venuekit.operators.activity import review_times
from venuekit.plans import datasets as D
from venuekit.session import new_path
from venuekit.sinks import tables as K
from venuekit.sources import geojson as GJ
from venuekit.sources import tables as T


def review_lines(spark, d):
    """Reviews as JSON lines: every 10th is cut short, every 15th has no user, every 21st a word for its stars."""
    key = F.col("review_id")
    reviews = V.reviews(spark, d).select(
        "review_id",
        F.to_json(
            F.struct(
                F.col("review_id").cast("string").alias("review_id"),
                F.when(key % 15 != 0, F.col("user_id").cast("string")).alias("user_id"),
                F.col("business_id").cast("string").alias("business_id"),
                F.when(key % 21 == 0, F.lit("many")).otherwise(F.col("stars").cast("string")).alias("stars"),
                "useful", "funny", "cool",
                F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"),
            )
        ).alias("line"),
    )
    # numbers are written bare, a word keeps its quotes
    bare = F.regexp_replace("line", r'"stars":"(\d+)"', r'"stars":$1')
    return reviews.select(
        F.when(key % 10 == 0, F.expr("substring(line, 1, length(line) - 9)")).otherwise(bare).alias("value")
    )


REQUIRED = ["business_id", "user_id", "stars"]

_GOOD = """
select cast(review_id as varchar) as review_id, cast(business_id as varchar) as business_id,
       cast(user_id as varchar) as user_id, cast(stars as double) as stars, useful, funny, cool,
       strftime(date, '%Y-%m-%d %H:%M:%S') as date from review_v"""


@query("scan_jsonl", _GOOD, "review_v")
def scan_jsonl(spark, d):
    path = new_path(spark, "reviews-jsonl")
    reviews = V.reviews(spark, d)
    reviews.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss")).write.json(path)
    return T.read_json_table(spark, path, S.REVIEW).drop("text")


@query("scan_business_jsonl", """
select cast(business_id as varchar) as business_id, name, city, state, postal_code, stars, review_count,
       cast(is_open as bigint) as is_open, categories, attr_wifi as wifi, attr_credit as credit,
       case when has_hours and business_id % 2 <> 0 then '9:0-17:0' end as monday,
       case when has_hours and business_id % 9 <> 0 then '9:0-17:0' end as sunday from business_v""", "business_v")
def scan_business_jsonl(spark, d):
    path = new_path(spark, "business-jsonl")
    V.businesses(spark, d).drop("category_array").write.json(path)
    return T.read_json_table(spark, path, S.BUSINESS).select(
        "business_id", "name", "city", "state", "postal_code", "stars", "review_count", "is_open", "categories",
        F.col("attributes.WiFi").alias("wifi"), F.col("attributes.BusinessAcceptsCreditCards").alias("credit"),
        F.col("hours.Monday").alias("monday"), F.col("hours.Sunday").alias("sunday"),
    )


@query("scan_checkin_jsonl", """
select cast(business_id as varchar) as business_id,
       strftime(t1, '%Y-%m-%d %H:%M:%S') || ', ' || strftime(t2, '%Y-%m-%d %H:%M:%S') as date from checkin_v""", "checkin_v")
def scan_checkin_jsonl(spark, d):
    path = new_path(spark, "checkin-jsonl")
    V.checkin_stamps(spark, d).select("business_id", F.concat_ws(", ", "t1", "t2").alias("date")).write.json(path)
    return T.read_json_table(spark, path, S.CHECKIN_LIST)


@query("valid_records", _GOOD + " where review_id % 10 <> 0 and review_id % 15 <> 0 and review_id % 21 <> 0", "review_v")
def valid_records(spark, d):
    checked = T.check_lines(review_lines(spark, d), S.REVIEW, REQUIRED)
    return T.valid_records(checked).drop("text")


@query("corrupt_counts", """
select case when review_id % 10 = 0 or review_id % 21 = 0 then 'parse_error' else 'missing_user_id' end as reason, count(*) as n
from review_v where review_id % 10 = 0 or review_id % 21 = 0 or review_id % 15 = 0 group by 1""", "review_v")
def corrupt_counts(spark, d):
    path = new_path(spark, "review-lines")
    review_lines(spark, d).write.text(path)
    return T.corrupt_counts(T.read_checked(spark, path, S.REVIEW, REQUIRED))


@query("lenient_scan", """
select cast(review_id as varchar) as review_id, case when review_id % 15 <> 0 then cast(user_id as varchar) end as user_id,
       case when review_id % 21 <> 0 then cast(stars as double) end as stars from review_v where review_id % 10 <> 0""", "review_v")
def lenient_scan(spark, d):
    path = new_path(spark, "review-lines")
    review_lines(spark, d).write.text(path)
    return T.read_lenient(spark, path, S.REVIEW).select("review_id", "user_id", "stars")


@query("read_or_build", f"""
select business_id, {r('avg_review_stars')} as avg_stars, {r('avg_useful')} as avg_useful from votes_v""", "votes_v")
def read_or_build(spark, d):
    missing = new_path(spark, "no-such-dataset")
    return rounded(
        T.read_or_build(
            lambda: spark.read.parquet(missing), lambda: R.review_averages(V.reviews(spark, d))
        )
    )


@query("read_or_empty", "select event_id, event_type, value from events")
def read_or_empty(spark, d):
    schema = "event_id long, event_type string, value double"
    kind = spark.createDataFrame([], schema).schema
    there = T.read_or_empty(spark, f"{d}/events.parquet", kind)
    return there.unionByName(T.read_or_empty(spark, new_path(spark, "no-such-dataset"), kind))


@query("first_available", "select doc_id, quality, toxic from labels")
def first_available(spark, d):
    kind = spark.createDataFrame([], "doc_id long, quality int, toxic int").schema
    return T.first_available(spark, [new_path(spark, "no-such-dataset"), f"{d}/labels.parquet"], kind)


_FEATURE = """
select name, cast(business_id as varchar) as business_id, stars, city, state, review_count, cast(is_open as bigint) as is_open,
       categories, longitude, latitude from {source}
where latitude is not null and longitude is not null and latitude <> 0 and longitude <> 0"""


@query("geojson_features", _FEATURE.format(source="geo_v"), "geo_v")
def geojson_features(spark, d):
    path = new_path(spark, "places-geojson")
    K.write_geojson(geo(spark, d), path, "features")
    return GJ.read_geojson_features(spark, path)


@query("geojson_rows", """
select business_id, '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || longitude || ',' || latitude
  || ']},"properties":{"name":"' || name || '","business_id":' || business_id || ',"stars":' || stars
  || ',"city":"' || city || '","state":"' || state || '","review_count":' || review_count || ',"is_open":' || is_open
  || case when categories is null then '' else ',"categories":"' || categories || '"' end || '}}' as value
from geo_v where latitude is not null and longitude is not null and latitude <> 0 and longitude <> 0""", "geo_v")
def geojson_rows(spark, d):
    return P.geojson_lines(P.geojson_features(geo(spark, d)))


@query("geojson_collection", _FEATURE.format(source="""(
  select * from geo_v where cast('0x' || substr(md5('42:' || business_id), 1, 8) as bigint) / 4294967296.0 < 0.1
  order by md5('42:' || business_id), business_id limit 5000) s"""), "geo_v")
def geojson_collection(spark, d):
    path = new_path(spark, "map-geojson")
    K.write_geojson(geo(spark, d), path, "collection")
    return GJ.read_geojson_collections(spark, path)


def geo(spark, d):
    return D.geo_dataset(V.businesses(spark, d), R.review_averages(V.reviews(spark, d)))


@query("write_roundtrip", f"""
select business_id, name, stars, review_count, {r('avg_review_stars')} as avg_review_stars, form
from analysis_v, (values ('parquet'), ('json')) as f(form)""", "analysis_v")
def write_roundtrip(spark, d):
    data = D.analysis_from(V.businesses(spark, d), V.reviews(spark, d)).select(
        "business_id", "name", "stars", "review_count", "avg_review_stars"
    )
    back = []
    for form in ("parquet", "json"):
        path = new_path(spark, f"analysis-{form}")
        K.write_table(data, path, form)
        back.append(spark.read.schema(data.schema).format(form).load(path).withColumn("form", F.lit(form)))
    return rounded(back[0].unionByName(back[1]))


@query("timed_reviews_roundtrip", """
select cast(year(date) as int) as review_year, count(*) as n, cast(sum(review_id) as bigint) as ids from review_v group by 1""",
       "review_v")
def timed_reviews_roundtrip(spark, d):
    path = new_path(spark, "reviews-by-year")
    K.write_timed_reviews(review_times(V.reviews(spark, d)), path)
    return (
        spark.read.parquet(path)
        .groupBy("review_year")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("review_id").alias("ids"))
    )
