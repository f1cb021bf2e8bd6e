"""Attribute encoders, labels and bands."""

from pyspark.sql import functions as F

from venue_queries import views as V
from venue_queries.registry import query, r, rounded
from venuekit.functions import encode as E
from venuekit.plans import datasets as D


def _encoded(expression, name):
    def run(spark, d):
        return V.businesses(spark, d).select("business_id", expression().alias(name))

    return run


def _level(name, column, expression):
    query(name, f"select business_id, {column} as level from feature_v", "feature_v")(_encoded(expression, "level"))


_level("enc_wifi_ordinal", "has_wifi", lambda: E.wifi_ordinal("attributes.WiFi"))
_level("enc_wifi_fraction", "wifi_share", lambda: E.wifi_fraction("attributes.WiFi"))
_level("enc_price", "price_level", lambda: E.price_level("attributes.RestaurantsPriceRange2"))
_level("enc_noise", "noise_level", lambda: E.noise_level("attributes.NoiseLevel"))
_level("enc_credit", "takes_credit_cards", lambda: E.true_flag("attributes.BusinessAcceptsCreditCards"))
_level("enc_reservations", "takes_reservations", lambda: E.true_flag("attributes.RestaurantsReservations"))

query("enc_wifi_strip_prefix", """
select business_id, case when attr_wifi in ('free', '''free''', 'u''free''') then 2.0::double
  when attr_wifi in ('paid', '''paid''', 'u''paid''') then 1.0::double else 0.0::double end as level from business_v""",
      "business_v")(_encoded(lambda: E.wifi_ordinal("attributes.WiFi", strip_prefix=True), "level"))


@query("category_array", """
select business_id, cast(len(string_split(categories, ', ')) as int) as n_categories,
       string_split(categories, ', ')[1] as first_category, string_split(categories, ', ')[-1] as last_category
from business_v""", "business_v")
def category_array(spark, d):
    words = E.category_array("categories")
    return V.businesses(spark, d).select(
        "business_id",
        F.when(words.isNotNull(), F.size(words)).alias("n_categories"),
        F.try_element_at(words, F.lit(1)).alias("first_category"),
        F.try_element_at(words, F.lit(-1)).alias("last_category"),
    )


@query("main_category", """
select business_id, coalesce(string_split(categories, ', ')[1], 'uncategorized') as main_category from business_v""",
       "business_v")
def main_category(spark, d):
    return V.businesses(spark, d).select("business_id", E.main_category(F.col("category_array")).alias("main_category"))


@query("success_flag", """
with s as (select business_id, case when business_id % 9 = 0 then null else stars end as stars from business_v)
select business_id, cast(stars >= 4.0 as double) as success_or_null,
       case when stars >= 4.0 then 1.0::double else 0.0::double end as success_or_zero from s""", "business_v")
def success_flag(spark, d):
    # some places are made unrated, to tell the two variants apart
    rated = V.businesses(spark, d).withColumn("stars", F.when(F.col("business_id") % 9 != 0, F.col("stars")))
    return rated.select(
        "business_id",
        E.success_or_null("stars").alias("success_or_null"),
        E.success_or_zero("stars").alias("success_or_zero"),
    )


@query("status_labels", """
select business_id, case is_open when 1 then 'Open' when 0 then 'Closed' end as status,
       case success when 1 then 'Successful' when 0 then 'Not Successful' end as category from feature_v""", "feature_v")
def status_labels(spark, d):
    return V.businesses(spark, d).select(
        "business_id",
        E.open_label("is_open").alias("status"),
        E.success_label(E.success_or_null("stars")).alias("category"),
    )


@query("rating_band4", """
with s as (select business_id, case when business_id % 9 <> 0 then stars end as stars from business_v)
select business_id, case when coalesce(stars, 0) >= 4.5 then 'darkgreen' when coalesce(stars, 0) >= 4.0 then 'green'
  when coalesce(stars, 0) >= 3.0 then 'orange' else 'red' end as color from s""", "business_v")
def rating_band4(spark, d):
    stars = F.when(F.col("business_id") % 9 != 0, F.col("stars"))
    return V.businesses(spark, d).select("business_id", E.rating_band(stars).alias("color"))


@query("rating_band3", """
select business_id, case when stars >= 4.0 then 'green' when stars >= 3.0 then 'blue' else 'red' end as color
from business_v""", "business_v")
def rating_band3(spark, d):
    return V.businesses(spark, d).select("business_id", E.rating_band("stars", E.RATING_BANDS_3).alias("color"))


@query("place_label", """
select business_id, name || chr(10) || 'Stars: ' || stars || chr(10) || 'Reviews: ' || review_count || chr(10)
       || 'City: ' || city || ', ' || state as label,
       name || chr(10) || 'Stars: ' || stars || chr(10) || 'Reviews: ' || review_count || chr(10)
       || 'Open: ' || case when is_open = 1 then 'Yes' else 'No' end as open_label
from business_v""", "business_v")
def place_label(spark, d):
    return V.businesses(spark, d).select(
        "business_id", E.place_label().alias("label"), E.status_label_line().alias("open_label")
    )


@query("business_features", """
select business_id, name, stars, review_count, is_open, has_wifi, price_level, noise_level, takes_reservations,
       array_to_string(string_split(categories, ', '), '|') as category_list from feature_v""", "feature_v")
def business_features(spark, d):
    features = D.business_features(V.businesses(spark, d))
    joined = F.when(F.col("category_array").isNotNull(), F.array_join("category_array", "|"))
    return features.withColumn("category_list", joined).drop("category_array")


@query("normalize_business", f"""
select cast(business_id as varchar) as business_id, name, city, state, stars, review_count, cast(is_open as bigint) as is_open,
       categories, attr_wifi as wifi, {r('latitude')} as latitude, shape
from business_v, (values ('flat'), ('nested')) as s(shape)""", "business_v")
def normalize_business(spark, d):
    flat = V.businesses(spark, d)
    nested = flat.select(
        "business_id", "name", F.struct("city", "state").alias("location"), "stars", "review_count", "is_open",
        "latitude", "longitude", "attributes", F.split("categories", ", ").alias("categories"),
    )
    def canonical(df, shape):
        return D.normalize_business(df).select(
            "business_id", "name", "city", "state", "stars", "review_count", "is_open", "categories",
            F.col("attributes.WiFi").alias("wifi"), "latitude", F.lit(shape).alias("shape"),
        )
    return rounded(canonical(flat.drop("category_array"), "flat").unionByName(canonical(nested, "nested")))
