"""Delimited text rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What would break a line or be taken for the end of a field, and how it is written instead; the backslash comes first.
ESCAPES = {"\\": "\\\\", "|": "\\|", "\n": "\\n", "\r": "\\r", "\t": "\\t"}


def escaped(text: Column) -> Column:
    """Text as one field of a line: ``unescaped`` gives it back."""
    for sign, written in ESCAPES.items():
        text = F.replace(text, F.lit(sign), F.lit(written))
    return text


def unescaped(field: Column) -> Column:
    """The text of an escaped field. Doubled backslashes are set apart first, so that no other sign is read into them."""
    parts = F.split(field, r"\\\\", -1)
    for sign, written in list(ESCAPES.items())[1:]:
        parts = F.transform(parts, lambda p, s=sign, w=written: F.replace(p, F.lit(w), F.lit(s)))
    return F.array_join(parts, "\\")


def sentiment_line(rollup: DataFrame, key: str = "business_id") -> DataFrame:
    """``reviews|stars|sentiment|length|users`` with two decimals for the means."""

    def mean(c: str):
        return F.format_string("%.2f", F.coalesce(c, F.lit(0.0)))

    return rollup.select(
        key,
        F.concat_ws(
            "|",
            F.col("total_reviews").cast("string"),
            mean("avg_stars"),
            mean("avg_sentiment"),
            mean("avg_text_length"),
            F.col("unique_users").cast("string"),
        ).alias("line"),
    )
