"""Franchise reports on sales (franchise_id, customer_id, sold_at, total_price, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyforge.functions.tiers import payment_category
from tallyforge.operators.totals import with_totals
from tallyforge.session import stored


def revenue_by_weekday(sales: DataFrame, pattern: str = "E") -> DataFrame:
    return sales.groupBy(F.date_format("sold_at", pattern).alias("day_of_week")).agg(
        F.sum("total_price").alias("total_revenue")
    )


def executive_report(sales: DataFrame, franchises: DataFrame, top: int = 5) -> DataFrame:
    """The largest franchises by revenue, with the most used payment category and the best weekday overall."""
    # The sales, often a costly join, are evaluated once: their cells per customer are written, and all is added up from them.
    cells = stored(
        sales.groupBy(
            "franchise_id", "customer_id",
            payment_category("payment_method").alias("category"),
            F.date_format("sold_at", "EEEE").alias("day"),
        ).agg(F.sum("total_price").alias("revenue"), F.count("*").alias("n")),
        "franchise-cells",
    )
    popular = (
        cells.groupBy("category").agg(F.sum("n").alias("n"))
        .agg(F.max_by(F.col("category"), F.struct("n", "category")).alias("most_popular_payment_category"))
    )
    best_day = (
        cells.groupBy("day").agg(F.sum("revenue").alias("revenue"))
        .agg(F.max_by(F.col("day"), F.struct("revenue", "day")).alias("highest_revenue_day_of_week"))
    )
    metrics = cells.groupBy("franchise_id").agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("n").alias("transaction_count"),
        F.round(F.sum("revenue") / F.sum("n"), 2).alias("avg_transaction_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    names = franchises.select(
        "franchise_id", F.col("name").alias("franchise_name"), F.col("city").alias("franchise_city"), "country"
    )
    largest = (
        metrics.join(names, "franchise_id", "left")
        .withColumn("avg_spend_per_customer", F.round(F.col("total_revenue") / F.col("unique_customers"), 2))
        .orderBy(F.desc("total_revenue"), "franchise_id")
        .limit(top)
    )
    return with_totals(with_totals(largest, popular), best_day)


def performance_report(sales: DataFrame, customers: DataFrame, franchises: DataFrame, country: str) -> DataFrame:
    """Revenue, transactions and customers per franchise of one country, for known customers.

    `customers` is unique per customer_id.
    """
    local = franchises.filter(F.col("country") == country).select("franchise_id", "name", "city", "country")
    per_pair = sales.groupBy("franchise_id", "customer_id").agg(
        F.sum("total_price").alias("revenue"), F.count("transaction_id").alias("n")
    )
    return (
        per_pair.join(local, "franchise_id")
        .join(customers.select("customer_id"), "customer_id")
        .groupBy("franchise_id", "name", "city", "country")
        .agg(
            F.sum("revenue").alias("total_revenue"),
            F.sum("n").alias("transaction_count"),
            F.count("*").alias("unique_customers"),
        )
        .orderBy(F.desc("total_revenue"), "franchise_id")
    )
