"""Declared schemas: no reader infers types, so no file is scanned twice."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

# Weekday names, Monday first.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Attribute names of the input data.
ATTRIBUTES = [
    "WiFi",
    "RestaurantsPriceRange2",
    "NoiseLevel",
    "BusinessAcceptsCreditCards",
    "RestaurantsReservations",
]


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_STR, _DBL, _LONG, _INT = StringType(), DoubleType(), LongType(), IntegerType()

ATTRIBUTES_TYPE = _struct(**{name: _STR for name in ATTRIBUTES})
HOURS_TYPE = _struct(**{day: _STR for day in WEEKDAYS})

BUSINESS = _struct(
    business_id=_STR, name=_STR, city=_STR, state=_STR, postal_code=_STR, latitude=_DBL, longitude=_DBL,
    stars=_DBL, review_count=_LONG, is_open=_LONG, attributes=ATTRIBUTES_TYPE, categories=_STR, hours=HOURS_TYPE,
)

# The other shape in circulation: place fields nested under "location", categories as an array.
BUSINESS_NESTED = _struct(
    business_id=_STR, name=_STR,
    location=_struct(city=_STR, state=_STR, postal_code=_STR, latitude=_DBL, longitude=_DBL), postal_code=_STR,
    latitude=_DBL, longitude=_DBL, stars=_DBL, review_count=_LONG, is_open=_LONG, attributes=ATTRIBUTES_TYPE,
    categories=ArrayType(_STR), hours=HOURS_TYPE,
)

REVIEW = _struct(
    review_id=_STR, user_id=_STR, business_id=_STR, stars=_DBL, useful=_LONG, funny=_LONG, cool=_LONG,
    text=_STR, date=_STR,
)

CHECKIN_LIST = _struct(business_id=_STR, date=_STR)
CHECKIN_MAP = _struct(business_id=_STR, time=MapType(_STR, _LONG))
CHECKIN_PAIRS = _struct(business_id=_STR, time=ArrayType(_struct(_1=_STR, _2=_LONG)))

# A mixed activity line: a review carries "date", a check-in carries "time".
ACTIVITY = _struct(business_id=_STR, date=_STR, time=MapType(_STR, _LONG))

CHECKIN_ROWS = _struct(
    business_id=_STR, checkin_timestamp=_STR, checkin_count=_INT, day_of_week=_STR, hour_of_day=_INT,
)

TEMPORAL = _struct(business_id=_STR, avg_growth_rate=_DBL, avg_star_change=_DBL, years_with_data=_LONG)

FEATURE_IMPORTANCE = _struct(feature=_STR, importance=_DBL)

GEOJSON_FEATURE = _struct(
    type=_STR,
    geometry=_struct(type=_STR, coordinates=ArrayType(_DBL)),
    properties=_struct(
        name=_STR, business_id=_STR, stars=_DBL, city=_STR, state=_STR, review_count=_LONG, is_open=_LONG,
        categories=_STR,
    ),
)
GEOJSON_COLLECTION = _struct(type=_STR, features=ArrayType(GEOJSON_FEATURE))
