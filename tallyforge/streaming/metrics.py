"""Aggregates over streams of sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyforge.operators.mergeable import Measure, distinct, row_count, total

LATENESS = "10 minutes"


def with_lateness(stream: DataFrame, time: str, delay: str = LATENESS) -> DataFrame:
    """Accept rows up to `delay` late. The column must be a timestamp with a zone."""
    return stream.withWatermark(time, delay)


def windowed_totals(stream: DataFrame, time: str, keys: Sequence[str], value: str, length: str = "1 hour") -> DataFrame:
    """Count, sum and mean per tumbling window and key, with the window's bounds as columns.

    In append mode a window is written once the watermark has passed its end.
    """
    return (
        stream.groupBy(F.window(time, length), *keys)
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum(value).alias("total_sales"),
            F.avg(value).alias("avg_transaction_value"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            "transaction_count",
            "total_sales",
            "avg_transaction_value",
        )
    )


def totals_by(stream: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, sum and mean per key since the start; for complete or update mode."""
    return stream.groupBy(*keys).agg(
        F.sum(value).alias("total_revenue"),
        F.count("*").alias("transaction_count"),
        F.avg(value).alias("avg_order_value"),
    )


def running_totals(stream: DataFrame, key: str, value: str, customer: str) -> DataFrame:
    """Totals per key with approximately distinct customers; streams cannot count them exactly."""
    return stream.groupBy(key).agg(
        F.sum(value).alias("total_sales"),
        F.count("*").alias("total_transactions"),
        F.approx_count_distinct(customer).alias("unique_customers"),
    )


def running_measures(value: str, customer: str) -> dict[str, Measure]:
    """The totals of `running_totals` in a form that is stored and merged, for `views.refresh_view`."""
    return {"total_sales": total(value), "total_transactions": row_count(), "unique_customers": distinct(customer)}


def across_keys(windows: DataFrame) -> DataFrame:
    """Totals per window over all keys, from the rows of `windowed_totals`."""
    return windows.groupBy("window_start", "window_end").agg(
        F.sum("transaction_count").alias("total_transactions"),
        F.sum("total_sales").alias("total_revenue"),
    )


def enrich(stream: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Inner join of a stream with a static table; rows without a match are dropped."""
    return stream.join(dimension.select(key, *columns), key)
