"""Review summaries that take in a new dump year by year instead of being computed anew.

Partial states, which can be merged, are stored by year: counts and sums of each business, and a sketch of its reviewers. A dump
that changes some years overwrites their folders only; whoever reads merges the years.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VOTES = ("useful", "funny", "cool")
#: base-2 logarithm of a sketch's registers: a standard error of about 1.6 %
REGISTERS = 12
YEAR = "review_year"


def yearly_states(reviews: DataFrame, key: str = "business_id") -> DataFrame:
    """What each business's reviews of a year come to: rows, sums with the number of values in them, and reviewers.

    ``reviews`` has ``review_year``; columns that it lacks count as null.
    """
    given = set(reviews.columns)
    sums = []
    for c in ("stars", *VOTES, "sentiment", "text_length"):
        value = F.col(c).cast("double") if c in given else F.lit(None).cast("double")
        sums += [F.sum(value).alias(f"{c}_sum"), F.count(value).alias(f"{c}_n")]
    user = F.col("user_id").cast("string") if "user_id" in given else F.lit(None).cast("string")
    return reviews.groupBy(YEAR, key).agg(
        F.count(F.lit(1)).alias("n"), *sums, F.hll_sketch_agg(user, REGISTERS).alias("users")
    )


def _years_in(spark: SparkSession, path: str) -> set:
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return set()
    # one row a year, from the folders' names
    return {row[0] for row in stored.select(YEAR).distinct().collect()}


def refresh(reviews: DataFrame, path: str, years: Iterable[int] | None = None, key: str = "business_id") -> None:
    """Bring the states at ``path`` up to date with ``reviews`` for the given years, or for all.

    Only reviews of these years are read, if the table is partitioned by year, and only their folders are written. A year
    that has no reviews any more loses its folder. Reviews without a date are a year of their own, which ``None`` names. Not
    to be run twice at a time on one path.
    """
    spark = reviews.sparkSession
    states = reviews
    if years is not None:
        years = set(years)
        wanted = F.col(YEAR).isin([y for y in years if y is not None])
        states = reviews.where((wanted | F.col(YEAR).isNull()) if None in years else wanted)
    # one task or more a year, split where a year is large
    (
        yearly_states(states, key).hint("rebalance", YEAR).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(path)
    )
    stored = _years_in(spark, path)
    # one row a year
    left = {row[0] for row in states.select(YEAR).distinct().collect()}
    left |= stored - years if years is not None else set()
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for year in stored - left:
        name = "__HIVE_DEFAULT_PARTITION__" if year is None else year
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{YEAR}={name}"), True)


def merged(states: DataFrame, key: str = "business_id") -> DataFrame:
    """Summary by business of all years read: as of one pass over all reviews, but for the reviewers, which are estimated."""

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n"))

    return states.groupBy(key).agg(
        F.sum("n").alias("review_count"), mean("stars").alias("avg_review_stars"), *[mean(c).alias(f"avg_{c}") for c in VOTES],
        mean("sentiment").alias("avg_sentiment"), mean("text_length").alias("avg_text_length"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("approx_users"),
    )


def yearly_counts(states: DataFrame, key: str = "business_id") -> DataFrame:
    """Reviews and mean stars by business and year, as growth needs them, without reading a review."""
    return states.where(F.col(YEAR).isNotNull()).select(
        key, YEAR, F.col("n").alias("yearly_reviews"), F.try_divide("stars_sum", "stars_n").alias("yearly_avg_stars")
    )
