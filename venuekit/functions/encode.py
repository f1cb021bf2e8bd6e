"""Attribute encoders, labels and bands as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Attribute codes and their numeric levels.
WIFI_ORDINAL = {"free": 2.0, "paid": 1.0}
WIFI_FRACTION = {"free": 1.0, "paid": 0.5}
NOISE_LEVEL = {"quiet": 1.0, "average": 2.0, "loud": 3.0, "very_loud": 4.0}
TRUE_WORDS = ["true", "True"]

# Rating thresholds and their marker colours.
RATING_BANDS_4 = [(4.5, "darkgreen"), (4.0, "green"), (3.0, "orange")]
RATING_BANDS_3 = [(4.0, "green"), (3.0, "blue")]
LOWEST_BAND = "red"

SUCCESS_STARS = 4.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _spellings(word: str) -> list[str]:
    """The bare word and the word in single quotes: both occur in the data."""
    return [word, f"'{word}'"]


def coded_level(
    value: Column | str, codes: dict[str, float], default: float, strip_prefix: bool = False
) -> Column:
    """Numeric level of a coded attribute. ``strip_prefix`` also accepts the ``u'word'`` spelling."""
    value = _col(value)
    if strip_prefix:
        value = F.regexp_replace(value, "^u'", "'")
    level = F.when(F.lit(False), F.lit(default))
    for word, number in codes.items():
        level = level.when(value.isin(*_spellings(word)), F.lit(float(number)))
    return level.otherwise(F.lit(float(default)))


def wifi_ordinal(value: Column | str, strip_prefix: bool = False) -> Column:
    """0 none, 1 paid, 2 free."""
    return coded_level(value, WIFI_ORDINAL, 0.0, strip_prefix)


def wifi_fraction(value: Column | str, strip_prefix: bool = False) -> Column:
    """0 none, 0.5 paid, 1 free: a different scale from ``wifi_ordinal``."""
    return coded_level(value, WIFI_FRACTION, 0.0, strip_prefix)


def noise_level(value: Column | str, strip_prefix: bool = False) -> Column:
    """1 quiet to 4 very loud; unknown counts as average."""
    return coded_level(value, NOISE_LEVEL, NOISE_LEVEL["average"], strip_prefix)


def price_level(value: Column | str) -> Column:
    """The number written in the attribute, 0 when there is none."""
    return F.coalesce(_col(value).try_cast("double"), F.lit(0.0))


def true_flag(value: Column | str) -> Column:
    """1.0 for the spellings of true, else 0.0 (credit cards, reservations)."""
    words = [s for word in TRUE_WORDS for s in _spellings(word)]
    return F.when(_col(value).isin(*words), 1.0).otherwise(0.0)


def category_array(categories: Column | str) -> Column:
    return F.split(_col(categories), ", ")


def main_category(categories: Column) -> Column:
    """First entry of a category array."""
    return F.coalesce(F.try_element_at(categories, F.lit(1)), F.lit("uncategorized"))


def success_or_null(stars: Column | str) -> Column:
    """1.0 / 0.0, null for unrated places."""
    return (_col(stars) >= SUCCESS_STARS).cast("double")


def success_or_zero(stars: Column | str) -> Column:
    """1.0 / 0.0, unrated places count as 0.0."""
    return F.when(_col(stars) >= SUCCESS_STARS, 1.0).otherwise(0.0)


def clip(value: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp to [lo, hi]; null and NaN give null (``greatest`` and ``least`` alone would return a bound)."""
    value = _col(value)
    out = value
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(value.isNotNull() & ~F.isnan(value), out)


def open_label(is_open: Column | str) -> Column:
    is_open = _col(is_open)
    return F.when(is_open == 1, "Open").when(is_open == 0, "Closed")


def success_label(success: Column | str) -> Column:
    success = _col(success)
    return F.when(success == 1, "Successful").when(success == 0, "Not Successful")


def rating_band(stars: Column | str, bands: list[tuple[float, str]] = RATING_BANDS_4) -> Column:
    """Marker colour by rating; missing and NaN fall in the lowest band (Spark orders NaN above all numbers)."""
    rating = F.nanvl(F.coalesce(_col(stars).cast("double"), F.lit(0.0)), F.lit(0.0))
    (first, colour), *rest = bands
    band = F.when(rating >= first, colour)
    for threshold, colour in rest:
        band = band.when(rating >= threshold, colour)
    return band.otherwise(LOWEST_BAND)


def place_label(name: str = "name", stars: str = "stars", reviews: str = "review_count",
                city: str = "city", state: str = "state") -> Column:
    """Marker text, one fact per line."""

    def known(c: str, otherwise: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(otherwise))

    return F.concat_ws(
        "\n",
        known(name, "Unknown"),
        F.concat(F.lit("Stars: "), known(stars, "N/A")),
        F.concat(F.lit("Reviews: "), known(reviews, "N/A")),
        F.concat(F.lit("City: "), known(city, "Unknown"), F.lit(", "), known(state, "Unknown")),
    )


def status_label_line(name: str = "name", stars: str = "stars", reviews: str = "review_count",
                      is_open: str = "is_open") -> Column:
    """Marker text of the second map: open yes or no instead of the city."""

    def known(c: str, otherwise: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(otherwise))

    return F.concat_ws(
        "\n",
        known(name, "Business"),
        F.concat(F.lit("Stars: "), known(stars, "N/A")),
        F.concat(F.lit("Reviews: "), known(reviews, "N/A")),
        F.concat(F.lit("Open: "), F.when(F.col(is_open) == 1, "Yes").otherwise("No")),
    )
