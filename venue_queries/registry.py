"""Queries by name, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from venue_queries.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the named views."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, *views) if views else sql.strip()
        return fn

    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """All doubles rounded: sums taken in another order differ in the last bits. Adding 0.0 turns -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(f.name, places) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, DoubleType) else f.name
            for f in df.schema.fields
        ]
    )


def r(expression: str, places: int = 6) -> str:
    """The same in SQL."""
    return f"(round(cast({expression} as double), {places}) + 0.0)"
