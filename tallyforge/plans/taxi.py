"""Taxi trips: features, repairs and the three-layer flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.functions.times import time_features, trip_metrics
from tallyforge.operators.changes import delete_where, update_where
from tallyforge.operators.dedup import keep_first

TRIP_KEY = ("pickup_at", "pickup_zip", "dropoff_zip")


def with_durations(trips: DataFrame) -> DataFrame:
    """Rounded trip minutes and speed; the speed is NULL when the trip takes no time."""
    minutes = F.round((F.unix_timestamp("dropoff_at") - F.unix_timestamp("pickup_at")) / 60.0, 2)
    speed = F.round(F.try_divide(F.col("trip_distance"), F.col("trip_duration_minutes") / 60), 2)
    return trips.withColumn("trip_duration_minutes", minutes).withColumn("avg_speed_mph", speed)


def with_features(trips: DataFrame) -> DataFrame:
    """Model features: hour, weekday, weekend, minutes and speed."""
    return trips.select(
        *trips.columns,
        time_features("pickup_at").alias("_time"),
        trip_metrics("pickup_at", "dropoff_at", "trip_distance").alias("_trip"),
    ).select(
        *trips.columns,
        F.col("_time.hour").alias("pickup_hour"),
        F.col("_time.day_of_week").alias("pickup_day_of_week"),
        F.col("_time.is_weekend").alias("is_weekend"),
        "_trip.trip_duration_minutes",
        "_trip.avg_speed_mph",
    )


def valid_features(features: DataFrame) -> DataFrame:
    """Trips with positive fare, distance, duration and a speed below 80."""
    return features.filter(
        "fare_amount > 0 AND trip_distance > 0 AND trip_duration_minutes > 0 "
        "AND avg_speed_mph > 0 AND avg_speed_mph < 80"
    )


def fares_as_decimal(trips: DataFrame, *order: Column) -> DataFrame:
    """De-duplicated on time and zones, fares as DECIMAL(10,2); NULL for a fare that does not fit."""
    return keep_first(trips, TRIP_KEY, *order).withColumn("fare_amount", money("fare_amount"))


def money(amount: str | Column) -> Column:
    """DECIMAL(10,2), or NULL where the amount does not fit."""
    return (F.col(amount) if isinstance(amount, str) else amount).try_cast("decimal(10,2)")


def surge_pricing(trips: DataFrame, zone: int, first_hour: int = 17, end_hour: int = 19) -> DataFrame:
    """Fares of one pickup zone raised by 10 % from first_hour up to, not including, end_hour."""
    hour = F.hour("pickup_at")
    peak = (F.col("pickup_zip") == zone) & (hour >= first_hour) & (hour < end_hour)
    raised = money(F.col("fare_amount") * F.lit("1.10").cast("decimal(3,2)"))
    return update_where(trips, peak, {"fare_amount": raised})


def invalid_trip() -> dict[str, Column]:
    """The conditions that make a trip invalid, by name."""
    return {
        "Invalid Fares": F.col("fare_amount") <= 0,
        "Invalid Distance": F.col("trip_distance") < 0,
        "Invalid Duration": F.col("trip_duration_minutes") <= 0,
    }


def without_invalid(trips: DataFrame) -> DataFrame:
    fares, distance, duration = invalid_trip().values()
    return delete_where(trips, fares | distance | duration)
