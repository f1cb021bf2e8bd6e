"""GeoJSON back to flat rows."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuekit.schema import GEOJSON_COLLECTION, GEOJSON_FEATURE


def _flat(feature: str) -> list[Column]:
    props = [
        F.col(f"{feature}.properties.{name}").alias(name)
        for name in GEOJSON_FEATURE["properties"].dataType.names
    ]
    point = F.col(f"{feature}.geometry.coordinates")
    return [*props, point[0].alias("longitude"), point[1].alias("latitude")]


def parse_collections(df: DataFrame, cell: str = "geojson") -> DataFrame:
    """One row per feature from cells that each hold a FeatureCollection."""
    features = df.select(F.explode(F.from_json(F.col(cell), GEOJSON_COLLECTION)["features"]).alias("f"))
    return features.select(*_flat("f"))


def parse_features(df: DataFrame, line: str = "value") -> DataFrame:
    """One row per feature from lines that each hold one feature."""
    return df.select(F.from_json(F.col(line), GEOJSON_FEATURE).alias("f")).select(*_flat("f"))


def read_geojson_collections(spark: SparkSession, path: str) -> DataFrame:
    return parse_collections(spark.read.schema("geojson string").json(path))


def read_geojson_features(spark: SparkSession, path: str) -> DataFrame:
    return parse_features(spark.read.text(path))
