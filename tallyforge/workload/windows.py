"""Window functions, sorting and top-k."""

from pyspark.sql import Window, functions as F

from tallyforge.functions.times import day_number
from tallyforge.operators import numbering, scans, windows
from tallyforge.plans import customers as customer_plans, reports
from tallyforge.workload.registry import day, query, r, rounded, stamp

TOTALS = """
    SELECT customer_id, name, state, sum(amount) AS total_spent, count(*) AS transaction_count
    FROM customers JOIN transactions USING (customer_id) GROUP BY 1, 2, 3
"""


def spent_by_customer(t):
    totals = customer_plans.profiles(t.transactions, "total_spent", "transaction_count")
    return t.customers.select("customer_id", "name", "state").join(totals, "customer_id")


@query(
    "wn01_top_per_group",
    f"""SELECT customer_id, state, round(total_spent, 2) AS total_spent, rank, row_number FROM (
          SELECT *, rank() OVER (PARTITION BY state ORDER BY total_spent DESC) AS rank,
                 row_number() OVER (PARTITION BY state ORDER BY total_spent DESC, customer_id) AS row_number
          FROM ({TOTALS})) WHERE rank <= 3""",
    "customers transactions",
)
def top_per_group(t):
    top = windows.top_by_rank(spent_by_customer(t), "state", "total_spent", "customer_id")
    return top.select(
        "customer_id", "state", r("total_spent").alias("total_spent"),
        F.col("rank").cast("long").alias("rank"), F.col("row_number").cast("long").alias("row_number"),
    )


@query(
    "wn02_percent_rank",
    f"""SELECT customer_id, round(percent_rank() OVER (ORDER BY total_spent DESC), 9) AS percentile_rank FROM ({TOTALS})""",
    "customers transactions",
)
def percent_rank(t):
    ranked = numbering.percent_rank(spent_by_customer(t), "total_spent", name="percentile_rank")
    return ranked.select("customer_id", r("percentile_rank", 9).alias("percentile_rank"))


MONTHLY = """
    SELECT customer_id, year(transaction_date)::INT AS year, month(transaction_date)::INT AS month,
           sum(amount) AS monthly_total FROM transactions GROUP BY 1, 2, 3
"""
GROWTH = f"""
    SELECT *, sum(monthly_total) OVER (PARTITION BY customer_id ORDER BY year, month ROWS UNBOUNDED PRECEDING) AS running_total,
           lag(monthly_total) OVER (PARTITION BY customer_id ORDER BY year, month) AS previous_total
    FROM ({MONTHLY})
"""


def growth(t):
    monthly = customer_plans.monthly_by_customer(t.transactions)
    return windows.running_growth(monthly, "customer_id", ["year", "month"], "monthly_total")


@query(
    "wn03_running_total",
    f"SELECT customer_id, year, month, round(monthly_total, 2) AS monthly_total, round(running_total, 2) AS running_total FROM ({GROWTH})",
    "transactions",
)
def running_total(t):
    columns = growth(t).select("customer_id", "year", "month", "monthly_total", "running_total")
    return rounded(columns, monthly_total=2, running_total=2)


@query(
    "wn04_previous_and_growth",
    f"""SELECT customer_id, year, month, coalesce(round(previous_total, 2), -1) AS previous_total,
               round(coalesce((monthly_total - previous_total) / previous_total * 100, 0), 4) AS growth_pct FROM ({GROWTH})""",
    "transactions",
)
def previous_and_growth(t):
    return growth(t).select(
        "customer_id", "year", "month",
        F.coalesce(r("previous_total"), F.lit(-1.0)).alias("previous_total"), r("growth_pct", 4).alias("growth_pct"),
    )


# Half of all rows have one key.
LOPSIDED = "SELECT event_id, ts, value, CASE WHEN event_id % 2 = 0 THEN -1 ELSE user_id END AS key FROM events"


@query(
    "wn03b_raw_rows_of_a_hot_key",
    f"""SELECT event_id, key, round(sum(value) OVER (w ROWS UNBOUNDED PRECEDING), 2) AS running_total,
               coalesce(round(lag(value) OVER w, 2), -1) AS previous_value, coalesce(round(lead(value) OVER w, 2), -1) AS next_value,
               round(avg(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving_avg,
               row_number() OVER w - 1 AS position
        FROM ({LOPSIDED}) WINDOW w AS (PARTITION BY key ORDER BY ts, event_id)""",
)
def raw_rows_of_a_hot_key(t):
    """Running and moving figures over raw rows, half of which have one key: that key is scanned in slices and chunks."""
    key = F.when(F.col("event_id") % 2 == 0, -1).otherwise(F.col("user_id")).alias("key")
    rows, order = t.events.select("event_id", "ts", "value", key), [F.col("ts"), F.col("event_id")]
    total = scans.running(rows, ["key"], order, running_total=F.col("value"), position=F.lit(1)).withColumn("position", F.col("position") - 1)
    seen = scans.framed(
        total, ["key"], order, back=2, ahead=1, position="position",
        previous_value=lambda w: F.lag("value").over(w), next_value=lambda w: F.lead("value").over(w),
        moving_avg=lambda w: F.avg("value").over(w.rowsBetween(-2, 0)),
    )
    return seen.select(
        "event_id", "key", r("running_total").alias("running_total"), "position",
        F.coalesce(r("previous_value"), F.lit(-1.0)).alias("previous_value"), F.coalesce(r("next_value"), F.lit(-1.0)).alias("next_value"),
        r("moving_avg", 4).alias("moving_avg"),
    )


SALES_BY_MONTH = """
    SELECT category, strftime(transaction_date, '%Y-%m') AS year_month, sum(amount) AS monthly_sales
    FROM transactions GROUP BY 1, 2
"""


def monthly_sales(t):
    return t.transactions.groupBy("category", F.date_format("transaction_date", "yyyy-MM").alias("year_month")).agg(
        F.sum("amount").alias("monthly_sales")
    )


@query(
    "wn05_next_value",
    f"""SELECT category, year_month, round(monthly_sales, 2) AS monthly_sales, round(previous_value, 2) AS previous_value,
               coalesce(round(next_value, 2), -1) AS next_value FROM (
          SELECT *, lag(monthly_sales) OVER w AS previous_value, lead(monthly_sales) OVER w AS next_value
          FROM ({SALES_BY_MONTH}) WINDOW w AS (PARTITION BY category ORDER BY year_month))
        WHERE previous_value IS NOT NULL""",
    "transactions",
)
def next_value(t):
    sales = windows.neighbours(monthly_sales(t), "category", ["year_month"], "monthly_sales", previous_value=1, next_value=-1)
    return sales.filter("previous_value IS NOT NULL").select(
        "category", "year_month", r("monthly_sales").alias("monthly_sales"), r("previous_value").alias("previous_value"),
        F.coalesce(r("next_value"), F.lit(-1.0)).alias("next_value"),
    )


def with_moving_figures(sales):
    month = F.col("monthly_sales")
    return windows.moving(sales, "category", ["year_month"], 3, moving_avg=F.avg(month), moving_sum=F.sum(month))


MOVING = f"""
    SELECT *, avg(monthly_sales) OVER (PARTITION BY category ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_avg,
           sum(monthly_sales) OVER (PARTITION BY category ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_sum,
           rank() OVER (PARTITION BY category ORDER BY monthly_sales DESC) AS sales_rank
    FROM ({SALES_BY_MONTH})
"""


@query(
    "wn06_moving_average",
    f"""SELECT category, year_month, round(moving_avg, 4) AS moving_avg, round(moving_sum, 2) AS moving_sum FROM ({MOVING})""",
    "transactions",
)
def moving_average(t):
    moved = with_moving_figures(monthly_sales(t))
    return rounded(moved.select("category", "year_month", "moving_avg", "moving_sum"), moving_avg=4, moving_sum=2)


@query(
    "wn07_rank_and_label",
    f"""SELECT category, year_month, sales_rank,
               CASE WHEN round(monthly_sales - moving_avg, 4) > 0 THEN 'Above Average'
                    WHEN round(monthly_sales - moving_avg, 4) < 0 THEN 'Below Average' ELSE 'At Average' END AS trend_indicator
        FROM ({MOVING})""",
    "transactions",
)
def rank_and_label(t):
    moved = with_moving_figures(monthly_sales(t))
    place = F.rank().over(Window.partitionBy("category").orderBy(F.desc("monthly_sales"))).cast("long")
    label = windows.against_average(r(F.col("monthly_sales") - F.col("moving_avg"), 4))
    return moved.select("category", "year_month", place.alias("sales_rank"), label.alias("trend_indicator"))


@query(
    "wn08b_deviation_in_a_hot_group",
    f"""SELECT event_id, CASE WHEN abs(value - avg(value) OVER g) > 2 * stddev_samp(value) OVER g THEN 'ANOMALY'
                             WHEN abs(value - avg(value) OVER g) > stddev_samp(value) OVER g THEN 'WARNING' ELSE 'NORMAL' END AS health_status
        FROM ({LOPSIDED}) WINDOW g AS (PARTITION BY nullif(key, 3))""",
)
def deviation_in_a_hot_group(t):
    """Raw rows against their group, where one group has half of them and one has no name."""
    key = F.when(F.col("event_id") % 2 == 0, -1).otherwise(F.col("user_id"))
    rows = t.events.select("event_id", "value", F.nullif(key, F.lit(3)).alias("key"))
    return windows.label_deviation(rows, ["key"], "value", spread_by=["event_id"]).select("event_id", "health_status")


@query(
    "wn08_deviation",
    """SELECT strftime(reading_date, '%Y-%m-%d') AS reading_date, location, status,
              CASE WHEN abs(v - avg(v) OVER g) > 2 * stddev_samp(v) OVER g THEN 'ANOMALY'
                   WHEN abs(v - avg(v) OVER g) > stddev_samp(v) OVER g THEN 'WARNING' ELSE 'NORMAL' END AS health_status
       FROM (SELECT timestamp::DATE AS reading_date, location, status, avg(value) AS v FROM sensors GROUP BY 1, 2, 3)
       WINDOW g AS (PARTITION BY location, status)""",
    "sensors",
)
def deviation(t):
    daily = t.sensors.groupBy(F.to_date("timestamp").alias("reading_date"), "location", "status").agg(
        F.avg("value").alias("avg_value")
    )
    labelled = windows.label_deviation(daily, ["location", "status"], "avg_value")
    return labelled.select(day("reading_date").alias("reading_date"), "location", "status", "health_status")


@query(
    "wn09_trend",
    f"""SELECT category, year_month, round(change, 4) AS change_pct,
               CASE WHEN change > 10 THEN 'Strong Growth' WHEN change > 0 THEN 'Growth'
                    WHEN change > -10 THEN 'Stable' ELSE 'Decline' END AS trend_direction
        FROM (SELECT *, (monthly_sales / lag(monthly_sales) OVER (PARTITION BY category ORDER BY year_month) - 1) * 100 AS change
              FROM ({SALES_BY_MONTH})) WHERE change IS NOT NULL""",
    "transactions",
)
def trend(t):
    sales = windows.neighbours(monthly_sales(t), "category", ["year_month"], "monthly_sales", previous_value=1)
    changed = sales.withColumn("change", windows.change_pct("monthly_sales", "previous_value")).filter("change IS NOT NULL")
    return changed.select(
        "category", "year_month", r("change", 4).alias("change_pct"), windows.change_label(F.col("change")).alias("trend_direction")
    )


@query(
    "wn10_ordered_batches",
    """SELECT event_id, least((row_number() OVER (ORDER BY ts, event_id) - 1) // (SELECT count(*) // 5 FROM events), 4)::INT
              AS batch_id FROM events""",
)
def ordered_batches(t):
    return numbering.ordered_batches(t.events, 5, F.col("ts"), F.col("event_id")).select("event_id", "batch_id")


@query("wn11_row_numbers", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS position FROM events")
def row_numbers(t):
    return numbering.number_rows(t.events, F.col("ts"), F.col("event_id"), name="position").select("event_id", "position")


@query(
    "wn12_ranked_customers",
    f"""SELECT customer_id, name, state, round(total_spent, 2) AS total_spent, transaction_count, state_rank,
               round(percentile_rank, 9) AS percentile_rank FROM (
          SELECT *, rank() OVER (PARTITION BY state ORDER BY total_spent DESC) AS state_rank,
                 percent_rank() OVER (ORDER BY total_spent DESC) AS percentile_rank FROM ({TOTALS})) WHERE state_rank <= 3""",
    "customers transactions",
)
def ranked_customers(t):
    ranked = reports.ranked_customers(t.transactions, t.customers)
    return rounded(ranked, total_spent=2, percentile_rank=9).select(
        "customer_id", "name", "state", "total_spent", "transaction_count",
        F.col("rank").cast("long").alias("state_rank"), "percentile_rank",
    )


@query("st01_sort", "SELECT n_name, n_regionkey FROM nation ORDER BY n_regionkey DESC, n_name")
def sort(t):
    return t.nation.select("n_name", "n_regionkey").orderBy(F.desc("n_regionkey"), "n_name")


@query("st02_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "st03_calendar_order",
    """SELECT strftime(sold_at, '%A') AS day_name, isodow(sold_at)::INT AS day_number, round(sum(total_price), 2) AS total_revenue
       FROM sales GROUP BY 1, 2 ORDER BY 2""",
    "sales",
)
def calendar_order(t):
    name = F.date_format("sold_at", "EEEE")
    return (
        t.sales.groupBy(name.alias("day_name"), day_number(name).alias("day_number"))
        .agg(r(F.sum("total_price")).alias("total_revenue"))
        .orderBy("day_number")
    )


@query(
    "st04_count_and_preview",
    "SELECT count(*) AS row_count, least(count(*), 5) AS previewed FROM lineitem",
)
def count_and_preview(t):
    """The preview stays lazy and bounded; nothing is collected."""
    preview = t.lineitem.limit(5).agg(F.count("*").alias("previewed"))
    return t.lineitem.agg(F.count("*").alias("row_count")).select("row_count", preview.scalar().alias("previewed"))
