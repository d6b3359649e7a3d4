"""Dates and times."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weekday labels, Spark's dayofweek counts from Sunday = 1.
DAY_LABELS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def day_label(ts: str) -> Column:
    """Three-letter weekday through a literal map."""
    pairs = [F.lit(x) for number, label in enumerate(DAY_LABELS, 1) for x in (number, label)]
    return F.element_at(F.create_map(*pairs), F.dayofweek(ts))


def day_number(day_name: Column) -> Column:
    """Monday 1 .. Sunday 7 from the English name, 0 for anything else."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.coalesce(F.array_position(names, day_name).cast("int"), F.lit(0))


def week_start(ts: str) -> Column:
    """Monday of the ISO week."""
    return F.date_trunc("week", ts).cast("date")


def on_weekend(ts: str) -> Column:
    """Whether the day is a Saturday or Sunday."""
    return F.dayofweek(ts).isin(1, 7)


def seconds_between(start: str, end: str) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def parse_feed_time(text: str) -> Column:
    """Timestamp from texts like 'Mon Apr 06 22:19:45 PDT 2009'; NULL when it does not parse.

    The weekday name cannot be parsed and carries no information, so it is cut off.
    """
    return F.try_to_timestamp(F.substr(F.col(text), F.lit(5)), F.lit("MMM dd HH:mm:ss zzz yyyy"))


def time_features(ts: str) -> Column:
    """struct(hour, day_of_week with Monday 0, is_weekend); 0 for a NULL timestamp."""
    weekday = F.coalesce(F.weekday(ts), F.lit(0))
    return F.struct(
        F.coalesce(F.hour(ts), F.lit(0)).alias("hour"),
        weekday.alias("day_of_week"),
        (weekday >= 5).cast("int").alias("is_weekend"),
    )


def trip_metrics(start: str, end: str, distance: str) -> Column:
    """struct(trip_duration_minutes, avg_speed_mph); speed is 0 unless the duration is positive."""
    minutes = seconds_between(start, end) / 60.0
    speed = F.when(minutes > 0, F.col(distance) / (minutes / 60.0)).otherwise(0.0)
    return F.struct(minutes.alias("trip_duration_minutes"), speed.alias("avg_speed_mph"))
