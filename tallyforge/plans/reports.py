"""Reports on transactions, customers, products and sensor readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyforge.functions.tiers import above
from tallyforge.operators.numbering import percent_rank
from tallyforge.operators.scans import weighted_quantiles
from tallyforge.operators.windows import label_deviation, top_by_rank
from tallyforge.plans.customers import profiles
from tallyforge.session import stored


def monthly_sales(transactions: DataFrame) -> DataFrame:
    """Sales, transactions, their mean and the customers of each month."""
    dated = transactions.withColumn("year_month", F.date_format("transaction_date", "yyyy-MM"))
    return profiles(dated, "total_sales", "transaction_count", "avg_transaction_amount", "unique_customers", by=["year_month"])


def lifetime_value_by_state(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers, revenue, mean, median and largest customer total per state.

    Mean and median are taken over transactions: a customer counts once per transaction. The median weights each
    customer's total by their transactions.
    """
    per_customer = (
        profiles(transactions, "total_spent", "transaction_count")
        .join(customers.select("customer_id", "state"), "customer_id")
    )
    per_customer = stored(per_customer, "customer-values")
    by_state = per_customer.groupBy("state").agg(
        F.count("*").alias("customer_count"),
        F.sum("total_spent").alias("total_revenue"),
        F.try_divide(
            F.sum(F.col("total_spent") * F.col("transaction_count")), F.sum("transaction_count")
        ).alias("avg_customer_ltv"),
        F.max("total_spent").alias("max_ltv"),
    )
    medians = weighted_quantiles(per_customer, ["state"], "total_spent", "transaction_count", median_ltv=0.5)
    same_state = F.col("s.state").eqNullSafe(F.col("m.state"))
    return by_state.alias("s").join(medians.alias("m"), same_state).select("s.*", "m.median_ltv")


# Ratios of the product report, each of two measures, to cents.
PERFORMANCE = {"sales_per_transaction": ("total_sales", "transaction_count"), "sales_per_customer": ("total_sales", "unique_customers")}


def product_performance(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """What each category sells, next to what it lists; a category that lists nothing has NULL there."""
    sells = profiles(transactions, "total_sales", "transaction_count", "avg_transaction", "unique_customers", by=["category"])
    lists = profiles(products, "product_count", "avg_product_price", "total_inventory", by=["category"])
    ratios = {name: F.round(F.try_divide(*pair), 2) for name, pair in PERFORMANCE.items()}
    return sells.join(lists, "category", "left").withColumns(ratios)


def ranked_customers(transactions: DataFrame, customers: DataFrame, k: int = 3) -> DataFrame:
    """The top k customers of each state with their percent rank among all customers."""
    totals = (
        profiles(transactions, "total_spent", "transaction_count")
        .join(customers.select("customer_id", "name", "state"), "customer_id")
    )
    ranked = percent_rank(totals, "total_spent", name="percentile_rank")
    return top_by_rank(ranked, "state", "total_spent", "customer_id", k)


def cohort_retention(transactions: DataFrame, customers: DataFrame, months: int = 12) -> DataFrame:
    """Share of each signup month's customers that buy in month 0..months after it."""
    return transactions.sparkSession.sql(
        """
        WITH cohorts AS (SELECT customer_id, trunc(signup_date, 'MM') AS cohort FROM {customers}),
        active AS (SELECT DISTINCT customer_id, trunc(transaction_date, 'MM') AS month FROM {transactions}),
        sizes AS (SELECT cohort, count(DISTINCT customer_id) AS cohort_size FROM cohorts GROUP BY cohort),
        lived AS (
          SELECT cohort, CAST(months_between(month, cohort) AS INT) AS months_since_signup,
                 count(DISTINCT customer_id) AS active_customers
          FROM active JOIN cohorts USING (customer_id) GROUP BY 1, 2)
        SELECT date_format(cohort, 'yyyy-MM') AS signup_cohort, cohort_size, months_since_signup, active_customers,
               round(active_customers * 100.0D / cohort_size, 2) AS retention_rate
        FROM lived JOIN sizes USING (cohort)
        WHERE months_since_signup BETWEEN 0 AND {months}
        """,
        transactions=transactions,
        customers=customers,
        months=months,
    )


def sensor_health(sensors: DataFrame) -> DataFrame:
    """Daily figures per location and status, labelled against the group's mean of daily means."""
    daily = sensors.groupBy(F.to_date("timestamp").alias("reading_date"), "location", "status").agg(
        F.avg("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count("*").alias("reading_count"),
        F.avg("battery_level").alias("avg_battery_level"),
        F.avg("signal_strength").alias("avg_signal_strength"),
    )
    return label_deviation(daily, ["location", "status"], "avg_value")


# The level of a location's mean reading on a day.
READING = ((75, "High"), (25, "Medium")), "Low"


def sensor_level_and_sales(sensors: DataFrame, transactions: DataFrame) -> DataFrame:
    """The sales of days by how high a location's active sensors read on them.

    Both sides become one row per day, and location, before they meet, so the join moves days and not readings.
    """
    on = {"reading": F.to_date("timestamp"), "sale": F.to_date("transaction_date")}
    read = profiles(sensors.where("status = 'active'").withColumn("day", on["reading"]), "avg_sensor_reading", by=["day", "location"])
    sold = profiles(transactions.withColumn("day", on["sale"]), "daily_sales", "transaction_count", by=["day"])
    limits, rest = READING
    days = read.join(sold, "day").withColumnRenamed("avg_sensor_reading", "value")
    rated = days.withColumn("sensor_category", above("value", limits, rest))
    return profiles(rated, "days_count", "avg_daily_sales", "avg_transactions", "avg_sensor_reading", by=["sensor_category"])
