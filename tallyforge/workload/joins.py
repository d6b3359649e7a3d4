"""Joins."""

from pyspark.sql import functions as F

from tallyforge.operators import joins
from tallyforge.operators.skew import broadcast_if_small, salted_join
from tallyforge.operators.totals import with_totals
from tallyforge.plans.customers import profiles, sales_by_state_and_category
from tallyforge.workload.registry import query, r, rounded


@query(
    "jn01_inner",
    "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def inner(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "jn02_left_outer",
    """SELECT customer_id, state, count(transaction_id) AS transaction_count, round(sum(amount), 2) AS total_spent
       FROM customers LEFT JOIN transactions USING (customer_id) GROUP BY 1, 2""",
    "customers transactions",
)
def left_outer(t):
    totals = profiles(t.transactions, "total_spent", "transaction_count")
    return t.customers.join(totals, "customer_id", "left").select(
        "customer_id", "state", F.coalesce("transaction_count", F.lit(0)).alias("transaction_count"),
        r("total_spent").alias("total_spent"),
    )


@query(
    "jn03_full_outer_counts",
    """SELECT coalesce(d.station, a.station) AS station, coalesce(departures, 0) AS departures,
              coalesce(arrivals, 0) AS arrivals
       FROM (SELECT start_station_name AS station, count(*) AS departures FROM trips_raw
             WHERE start_station_name IS NOT NULL GROUP BY 1) d
       FULL JOIN (SELECT CASE WHEN end_station_id::INT % 5 = 0 THEN end_station_name || ' depot' ELSE end_station_name END AS station,
                         count(*) AS arrivals FROM trips_raw GROUP BY 1) a ON d.station = a.station""",
    "trips_raw",
)
def full_outer_counts(t):
    """Some trips end at depots, where none starts, so both sides have stations the other lacks."""
    departures = (
        t.trips_raw.filter("start_station_name IS NOT NULL")
        .groupBy(F.col("start_station_name").alias("station")).agg(F.count("*").alias("departures"))
    )
    depot = F.concat("end_station_name", F.lit(" depot"))
    end = F.when(F.col("end_station_id").cast("int") % 5 == 0, depot).otherwise(F.col("end_station_name"))
    arrivals = t.trips_raw.groupBy(end.alias("station")).agg(F.count("*").alias("arrivals"))
    return joins.merge_counts(departures, arrivals, ["station"], ["departures", "arrivals"])


@query(
    "jn04_with_one_row",
    """SELECT s_suppkey, s_acctbal, round(mean, 6) AS mean, largest
       FROM supplier CROSS JOIN (SELECT avg(s_acctbal) AS mean, max(s_acctbal) AS largest FROM supplier)""",
)
def with_one_row(t):
    overall = t.supplier.agg(F.avg("s_acctbal").alias("mean"), F.max("s_acctbal").alias("largest"))
    return rounded(with_totals(t.supplier.select("s_suppkey", "s_acctbal"), overall), mean=6)


@query("jn05_without_match", "SELECT * FROM (SELECT c_custkey, c_name FROM customer UNION ALL SELECT -1 - c_custkey, c_name FROM customer) WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def without_match(t):
    """Every customer has orders, so prospects with keys of their own are added."""
    people = t.customer.select("c_custkey", "c_name")
    prospects = people.withColumn("c_custkey", -1 - F.col("c_custkey"))
    return joins.without_match(people.unionByName(prospects), t.orders, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query(
    "jn06_consecutive_months",
    """WITH m AS (SELECT customer_id, date_trunc('month', transaction_date) AS month, sum(amount) AS spent
                  FROM transactions GROUP BY 1, 2)
       SELECT c.customer_id, strftime(c.month, '%Y-%m') AS year_month, round(c.spent, 2) AS monthly_spending,
              round(p.spent, 2) AS previous_value, round((c.spent - p.spent) / p.spent * 100, 4) AS growth_rate
       FROM m c JOIN m p ON c.customer_id = p.customer_id AND p.month + INTERVAL 1 MONTH = c.month
       WHERE (c.spent - p.spent) / p.spent * 100 > 20""",
    "transactions",
)
def consecutive_months(t):
    monthly = t.transactions.groupBy(
        "customer_id", F.date_format("transaction_date", "yyyy-MM").alias("year_month")
    ).agg(F.sum("amount").alias("monthly_spending"))
    pairs = joins.consecutive_months(monthly, "customer_id", "year_month", "monthly_spending")
    return rounded(pairs.filter("growth_rate > 20"), monthly_spending=2, previous_value=2, growth_rate=4)


@query(
    "jn07_checked_broadcast",
    """SELECT customer_id, state, country FROM customers
       LEFT JOIN (SELECT n_name AS state, r_name AS country FROM nation JOIN region ON n_regionkey = r_regionkey) USING (state)""",
    "customers",
)
def checked_broadcast(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("state"), F.col("r_name").alias("country")
    )
    return t.customers.join(broadcast_if_small(places, max_rows=10_000), "state", "left").select(
        "customer_id", "state", "country"
    )


@query(
    "jn08_star",
    """SELECT s.transaction_id, s.product, s.total_price, c.name AS customer_name, f.name AS franchise_name,
              f.city AS franchise_city, f.country
       FROM sales s JOIN customers c ON s.customer_id = c.customer_id JOIN franchises f ON s.franchise_id = f.franchise_id""",
    "sales customers franchises",
)
def star(t):
    with_customer = joins.join_with(
        t.sales, t.customers, F.expr("l.customer_id = r.customer_id"), {"name": "customer_name"}
    )
    return joins.join_with(
        with_customer, t.franchises, F.expr("l.franchise_id = r.franchise_id"),
        {"name": "franchise_name", "city": "franchise_city", "country": "country"},
    ).select("transaction_id", "product", "total_price", "customer_name", "franchise_name", "franchise_city", "country")


@query(
    "jn09_filter_around_join",
    """SELECT transaction_id, state FROM transactions JOIN customers USING (customer_id)
       WHERE amount > 300000 AND state = 'NATION_3'""",
    "transactions customers",
)
def filter_around_join(t):
    joined = t.transactions.join(t.customers, "customer_id")
    return joined.filter((F.col("amount") > 300_000) & (F.col("state") == "NATION_3")).select("transaction_id", "state")


@query(
    "jn10_aggregate_before_join",
    """SELECT state, category, round(sum(amount), 2) AS total_amount, count(*) AS transaction_count
       FROM transactions JOIN customers USING (customer_id) GROUP BY 1, 2""",
    "transactions customers",
)
def aggregate_before_join(t):
    return rounded(sales_by_state_and_category(t.transactions, t.customers), total_amount=2)


@query(
    "jn11_derived_table",
    """SELECT name, state, round(total_spent, 2) AS total_spent FROM customers
       JOIN (SELECT customer_id, sum(amount) AS total_spent FROM transactions GROUP BY 1) USING (customer_id)
       WHERE total_spent > 3000000""",
    "customers transactions",
)
def derived_table(t):
    return t.spark.sql(
        """WITH totals AS (SELECT customer_id, sum(amount) AS total_spent FROM {transactions} GROUP BY customer_id)
           SELECT name, state, round(total_spent, 2) AS total_spent
           FROM {customers} JOIN totals USING (customer_id) WHERE total_spent > 3000000""",
        transactions=t.transactions, customers=t.customers,
    )


@query(
    "jn12_sums_with_counts",
    "SELECT category, round(sum(amount) / count(*), 6) AS mean FROM transactions GROUP BY 1",
    "transactions",
)
def sums_with_counts(t):
    return t.transactions.groupBy("category").agg(r(F.sum("amount") / F.count("*"), 6).alias("mean"))


@query(
    "jn13_daily_aggregates",
    """SELECT strftime(day, '%Y-%m-%d') AS day, orders_placed, lines_shipped
       FROM (SELECT o_orderdate::DATE AS day, count(*) AS orders_placed FROM orders GROUP BY 1)
       JOIN (SELECT l_shipdate::DATE AS day, count(*) AS lines_shipped FROM lineitem GROUP BY 1) USING (day)""",
)
def daily_aggregates(t):
    placed = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders_placed"))
    shipped = t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("lines_shipped"))
    return placed.join(shipped, "day").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "jn14_hot_key",
    """SELECT event_id, event_type, value, round(mean, 6) AS mean FROM events
       JOIN (SELECT event_type, avg(value) AS mean FROM events GROUP BY 1) USING (event_type)""",
)
def hot_key(t):
    """A handful of keys hold all rows: every key is hot and gets salted."""
    means = t.events.groupBy("event_type").agg(F.avg("value").alias("mean"))
    joined = salted_join(t.events, means, ["event_type"], ["event_id"])
    return rounded(joined, mean=6).select("event_id", "event_type", "value", "mean")
