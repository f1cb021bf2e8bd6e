"""Time patterns: routing of activity records, check-in expansion, calendar summaries and weekly profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType

from venuekit.functions.timeparts import PATTERN, as_timestamp, parse_stamp, weekday_name, with_time_parts
from venuekit.schema import ACTIVITY, WEEKDAYS
from venuekit.sources.tables import REASON, check_lines

KINDS = ["review", "checkin"]
HOURS = [f"{h:02d}" for h in range(24)]


def expand_checkins(checkins: DataFrame, key: str = "business_id") -> DataFrame:
    """One row per check-in stamp, with its count, weekday name and hour.

    Accepts the three shapes in use: ``date`` holding "t1, t2, ...", ``time`` as a map stamp -> count, and ``time``
    as an array of (stamp, count) pairs.
    """
    fields = {f.name: f.dataType for f in checkins.schema}
    if isinstance(fields.get("time"), MapType):
        rows = checkins.select(key, F.explode("time").alias("checkin_timestamp", "checkin_count"))
    elif isinstance(fields.get("time"), ArrayType):
        stamp, count = fields["time"].elementType.names
        rows = checkins.select(key, F.explode("time").alias("e")).select(
            key, F.col(f"e.{stamp}").alias("checkin_timestamp"), F.col(f"e.{count}").alias("checkin_count")
        )
    elif isinstance(fields.get("date"), StringType):
        rows = checkins.select(
            key, F.explode(F.split("date", r"\s*,\s*")).alias("checkin_timestamp")
        ).filter(F.trim("checkin_timestamp") != "").withColumn("checkin_count", F.lit(1))
    else:
        raise ValueError("check-ins need a 'date' list or a 'time' map or array")
    rows = rows.withColumn("checkin_timestamp", F.trim(F.col("checkin_timestamp").cast("string")))
    ts = parse_stamp(F.col("checkin_timestamp"))
    return rows.select(
        key,
        "checkin_timestamp",
        F.col("checkin_count").cast("int").alias("checkin_count"),
        weekday_name(ts).alias("day_of_week"),
        F.hour(ts).alias("hour_of_day"),
    )


def route_activity(records: DataFrame, key: str = "business_id") -> DataFrame:
    """Type a mixed record and keep its weekday and hour: ``date`` makes a review, else ``time`` a check-in.

    ``date`` and ``time`` are timestamps or text; records with neither, or without a business, are skipped, records whose
    stamp does not parse are dropped. Check-ins use their own time.
    """
    typed = records.filter(F.col(key).isNotNull()).select(
        key,
        F.when(F.col("date").isNotNull(), KINDS[0]).when(F.col("time").isNotNull(), KINDS[1]).alias("kind"),
        F.when(F.col("date").isNotNull(), as_timestamp(records, "date"))
        .otherwise(as_timestamp(records, "time"))
        .alias("ts"),
    )
    return typed.filter(F.col("kind").isNotNull() & F.col("ts").isNotNull()).select(
        key, "kind", weekday_name(F.col("ts")).alias("day_of_week"), F.hour("ts").alias("hour_of_day")
    )


def check_activity(lines: DataFrame, line: str = "value") -> DataFrame:
    """Parse mixed activity records and say which are corrupt: undecodable, or a review whose date does not parse.

    Records of another type (no business, or neither ``date`` nor ``time``) are left out and not counted as corrupt; one
    whose ``time`` is there and no map is corrupt.
    """
    checked = check_lines(lines, ACTIVITY, [], line, typed=["business_id", "date", "time"])
    dated = F.col("date").isNotNull()
    bad_date = F.col("business_id").isNotNull() & dated & as_timestamp(checked, "date", PATTERN).isNull()
    return checked.withColumn(REASON, F.coalesce(REASON, F.when(bad_date, "bad_date"))).filter(
        F.col(REASON).isNotNull() | (F.col("business_id").isNotNull() & (dated | F.col("time").isNotNull()))
    )


def route_records(records: DataFrame, key: str = "business_id") -> DataFrame:
    """One row per review and per check-in stamp of parsed mixed records, with kind, weekday, hour and weight."""
    is_review = F.col("date").isNotNull()
    one = F.array(F.struct(F.col("date").alias("stamp"), F.lit(1).cast("long").alias("weight")))
    several = F.transform(
        F.map_entries("time"), lambda e: F.struct(e["key"].alias("stamp"), e["value"].alias("weight"))
    )
    stamps = records.select(
        key, F.when(is_review, KINDS[0]).otherwise(KINDS[1]).alias("kind"),
        F.inline(F.when(is_review, one).otherwise(several)),
    ).withColumn("ts", parse_stamp(F.col("stamp"), strict=True))
    return stamps.filter(F.col("ts").isNotNull()).select(
        key, "kind", weekday_name(F.col("ts")).alias("day_of_week"), F.hour("ts").alias("hour_of_day"), "weight"
    )


def activity_from(reviews: DataFrame, checkin_rows: DataFrame, key: str = "business_id") -> DataFrame:
    """The routed form built from a review table and expanded check-ins; a check-in weighs its count."""
    ts = as_timestamp(reviews, "date")
    from_reviews = reviews.select(
        key, F.lit(KINDS[0]).alias("kind"), weekday_name(ts).alias("day_of_week"),
        F.hour(ts).alias("hour_of_day"), F.lit(1).alias("weight"),
    )
    from_checkins = checkin_rows.select(
        key, F.lit(KINDS[1]).alias("kind"), "day_of_week", "hour_of_day", F.col("checkin_count").alias("weight")
    )
    return from_reviews.unionByName(from_checkins).filter(F.col("hour_of_day").isNotNull())


def _slot_counts(activity: DataFrame, key: str, weight: str | None) -> DataFrame:
    """All 62 weekday and hour counters per business.

    Rows are first counted by business and (kind, weekday, hour) code, at most 336 per business, and only those narrow
    counts are brought together by business. The 62 wide counters are built after that exchange and never shuffled,
    and a very popular business arrives as 336 rows.
    """
    amount = F.col(weight).cast("long") if weight else F.lit(1).cast("long")

    def position(values: list[str], column: str) -> Column:
        return F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column)).cast("int") - 1

    code = (position(KINDS, "kind") * 7 + position(WEEKDAYS, "day_of_week")) * 24 + F.col("hour_of_day")
    counted = (
        activity.filter(F.col("kind").isin(KINDS) & F.col("day_of_week").isin(WEEKDAYS))
        .groupBy(key, code.alias("code"))
        .agg(F.sum(amount).alias("n"))
        .repartition(key)
        .select(
            key, "n", (F.col("code") / 168).cast("int").alias("kind"),
            (F.col("code") / 24 % 7).cast("int").alias("day"), (F.col("code") % 24).alias("hour"),
        )
    )
    counters = [
        F.expr(f"coalesce(sum(if(kind = {k} and {unit} = {i}, n, null)), 0) as {kind}_{value}")
        for unit, values in (("day", WEEKDAYS), ("hour", list(range(24))))
        for i, value in enumerate(values)
        for k, kind in enumerate(KINDS)
    ]
    return counted.groupBy(key).agg(*counters)


def temporal_profile(activity: DataFrame, key: str = "business_id", weight: str | None = None) -> DataFrame:
    """Per business, two arrays of (slot, reviews, checkins): weekdays from Monday and hours 00 to 23, zero-filled."""

    def slots(labels: list[str], values: list) -> Column:
        cells = [
            f"named_struct('slot', '{label}', 'reviews', review_{value}, 'checkins', checkin_{value})"
            for label, value in zip(labels, values)
        ]
        return F.expr(f"array({', '.join(cells)})")

    counts = _slot_counts(activity, key, weight)
    return counts.select(
        key, slots(WEEKDAYS, WEEKDAYS).alias("day_profile"), slots(HOURS, list(range(24))).alias("hour_profile")
    )


def temporal_profile_long(profile: DataFrame, key: str = "business_id") -> DataFrame:
    """The profile with one row per business and slot."""

    def rows(unit: str) -> Column:
        return F.transform(
            f"{unit}_profile",
            lambda s: F.struct(
                F.lit(unit).alias("unit"), s["slot"].alias("slot"), s["reviews"].alias("reviews"),
                s["checkins"].alias("checkins"),
            ),
        )

    both = F.concat(rows("day"), rows("hour"))
    return profile.select(key, F.inline(both))


def profile_line(profile: DataFrame, key: str = "business_id") -> DataFrame:
    """The profile as text: ``day_profile:Monday:r/c,...|hour_profile:00:r/c,...``."""

    def part(c: str) -> Column:
        cells = F.transform(
            c,
            lambda s: F.concat(s["slot"], F.lit(":"), s["reviews"].cast("string"), F.lit("/"),
                               s["checkins"].cast("string")),
        )
        return F.concat(F.lit(f"{c}:"), F.array_join(cells, ","))

    return profile.select(key, F.concat_ws("|", part("day_profile"), part("hour_profile")).alias("line"))


def review_times(reviews: DataFrame, column: str = "date") -> DataFrame:
    """Reviews with their calendar parts."""
    return with_time_parts(reviews, column, "review")


def calendar_counts(timed: DataFrame, stars: str = "stars") -> DataFrame:
    """Shared pre-aggregate on (year, month, weekday, hour): every calendar report re-adds these few rows."""
    return timed.groupBy("review_year", "review_month", "review_day", "review_hour").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.sum(F.col(stars).cast("double")).alias("stars_sum"),
        F.count(stars).alias("stars_n"),
    )


def rollup_calendar(calendar: DataFrame, *parts: str) -> DataFrame:
    """Reviews and mean stars by calendar parts, from the pre-aggregate."""
    return calendar.groupBy(*parts).agg(
        F.sum("review_count").alias("review_count"),
        F.try_divide(F.sum("stars_sum"), F.sum("stars_n")).alias("avg_stars"),
    )


def reviews_by(timed: DataFrame, *parts: str, stars: str = "stars") -> DataFrame:
    """Reviews and mean stars by calendar parts, straight from the reviews (for a single report)."""
    return timed.groupBy(*parts).agg(F.count(F.lit(1)).alias("review_count"), F.avg(stars).alias("avg_stars"))


def name_weekdays(by_day: DataFrame) -> DataFrame:
    """Replace the weekday number by its name and put the days in calendar order, Sunday first."""
    calendar_order = [WEEKDAYS[-1], *WEEKDAYS[:-1]]
    names = F.array(*[F.lit(day) for day in calendar_order])
    return (
        by_day.withColumn("day_name", F.try_element_at(names, F.col("review_day")))
        .orderBy("review_day")
    )


def checkins_by_weekday(checkin_rows: DataFrame) -> DataFrame:
    """Check-in rows and their summed counts by weekday name."""
    return checkin_rows.groupBy("day_of_week").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("checkin_count").alias("weighted")
    )


def sentiment_by_month(scored_timed: DataFrame) -> DataFrame:
    """Reviews and mean sentiment by calendar month over all years."""
    return scored_timed.groupBy("review_month").agg(
        F.count(F.lit(1)).alias("review_count"), F.avg("sentiment").alias("avg_sentiment")
    )
