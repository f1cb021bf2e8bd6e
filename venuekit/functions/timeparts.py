"""Timestamps and their calendar parts. Unparsable text gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from venuekit.schema import WEEKDAYS

# Fixed value: the input pattern of dates.
PATTERN = "yyyy-MM-dd HH:mm:ss"


def parse_stamp(text: Column, strict: bool = False) -> Column:
    """Text as a timestamp without a zone, so that its hour does not depend on the session's; ``strict`` wants ``PATTERN``."""
    stamp = text.try_cast("timestamp_ntz")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"), stamp) if strict else stamp


def as_timestamp(df: DataFrame, column: str, pattern: str | None = None) -> Column:
    """``column`` as a timestamp, parsed only when it is text."""
    if isinstance(df.schema[column].dataType, StringType):
        return parse_stamp(F.col(column), strict=pattern is not None)
    return F.col(column)


def with_time_parts(df: DataFrame, column: str, prefix: str = "review") -> DataFrame:
    """Add ``<prefix>_year/_month/_day/_hour``; day is 1 for Sunday to 7 for Saturday."""
    ts = as_timestamp(df, column)
    return df.withColumns(
        {
            f"{prefix}_year": F.year(ts),
            f"{prefix}_month": F.month(ts),
            f"{prefix}_day": F.dayofweek(ts),
            f"{prefix}_hour": F.hour(ts),
        }
    )


def weekday_name(ts: Column) -> Column:
    """English weekday name, by lookup: formatting each date costs several times as much."""
    return F.get(F.array(*[F.lit(day) for day in WEEKDAYS]), F.weekday(ts))
