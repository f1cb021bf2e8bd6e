"""Writers for datasets, text rows, GeoJSON and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuekit.operators.places import geojson_collection, geojson_features, geojson_lines


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace the dataset at ``path``."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_timed_reviews(timed: DataFrame, path: str) -> None:
    """Reviews partitioned by year, so a year filter reads its own folders.

    The rebalance hint brings a year together without letting a busy one end in one task: adaptive execution
    splits what exceeds its advisory partition size and merges what falls below.
    """
    write_table(timed.hint("rebalance", "review_year"), path, partition_by=["review_year"])


def write_grouped_lines(lines: DataFrame, path: str, group: str, key: str, line: str = "line") -> None:
    """Text rows ``group<TAB>line``, groups together and in order.

    Ranges are cut on (group, key), so a very large group runs over several files.
    """
    ordered = lines.repartitionByRange(group, key).sortWithinPartitions(group, key)
    ordered.select(F.concat_ws("\t", group, line).alias("value")).write.mode("overwrite").text(path)


def write_geojson(places: DataFrame, path: str, form: str = "features") -> None:
    """All places as one feature per line, or the map extract as a collection in one cell."""
    if form == "features":
        geojson_lines(geojson_features(places)).select("value").write.mode("overwrite").text(path)
    elif form == "collection":
        write_table(geojson_collection(places), path, "json")
    else:
        raise ValueError(f"unknown form {form!r}")


def save_model(model: MLWritable, *paths: str) -> str:
    """Save to the first path that can be written and return it."""
    failure: Exception | None = None
    for path in paths:
        try:
            model.write().overwrite().save(path)
            return path
        except (Py4JJavaError, PySparkException) as error:
            failure = error
    raise failure or ValueError("no path given")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Save as a table in ``buckets`` buckets by ``key``, sorted in each, and return it.

    Tables in equally many buckets by the same key are joined and aggregated by it without an exchange. Rows are dealt to
    the buckets before writing, so a bucket is one file.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)
