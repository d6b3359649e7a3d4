"""Whole reports."""

from pyspark.sql import functions as F

from tallyforge.operators import evaluation, windows
from tallyforge.plans import customers as cust, franchises, orders, posts, reports, taxi, trips
from tallyforge.workload.registry import day, query, r, rounded, stamp


@query(
    "pl01_monthly_sales",
    """SELECT strftime(transaction_date, '%Y-%m') AS year_month, round(sum(amount), 2) AS total_sales, count(*) AS transaction_count,
              round(avg(amount), 6) AS avg_transaction_amount, count(DISTINCT customer_id) AS unique_customers
       FROM transactions GROUP BY 1""",
    "transactions",
)
def monthly_sales(t):
    return rounded(reports.monthly_sales(t.transactions), total_sales=2, avg_transaction_amount=6)


@query(
    "pl02_lifetime_value",
    """SELECT state, count(DISTINCT c.customer_id) AS customer_count, round(sum(t.amount), 2) AS total_revenue,
              round(avg(x.total_spent), 3) AS avg_customer_ltv, round(quantile_disc(x.total_spent, 0.5), 2) AS median_ltv,
              round(max(x.total_spent), 2) AS max_ltv
       FROM customers c JOIN transactions t USING (customer_id)
       JOIN (SELECT customer_id, sum(amount) AS total_spent FROM transactions GROUP BY 1) x USING (customer_id) GROUP BY 1""",
    "customers transactions",
)
def lifetime_value(t):
    values = reports.lifetime_value_by_state(t.transactions, t.customers)
    return rounded(values, total_revenue=2, avg_customer_ltv=3, median_ltv=2, max_ltv=2)


@query(
    "pl03_product_performance",
    """SELECT s.category, round(total_sales, 2) AS total_sales, transaction_count, round(avg_transaction, 6) AS avg_transaction,
              unique_customers, product_count, round(avg_product_price, 6) AS avg_product_price, total_inventory,
              round(total_sales / transaction_count, 2) AS sales_per_transaction, round(total_sales / unique_customers, 2) AS sales_per_customer
       FROM (SELECT category, sum(amount) AS total_sales, count(*) AS transaction_count, avg(amount) AS avg_transaction,
                    count(DISTINCT customer_id) AS unique_customers
             FROM (SELECT customer_id, l_quantity * 100 AS amount, p_type AS category FROM transactions
                   JOIN lineitem ON transaction_id = l_orderkey JOIN part ON l_partkey = p_partkey) GROUP BY 1) s
       LEFT JOIN (SELECT category, count(*) AS product_count, avg(price) AS avg_product_price, sum(stock_quantity)::BIGINT AS total_inventory
                  FROM products GROUP BY 1) p USING (category)""",
    "transactions products",
)
def product_performance(t):
    sold = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.transactions.select("transaction_id", "customer_id"), F.col("l_orderkey") == F.col("transaction_id"))
        .select("customer_id", (F.col("l_quantity") * 100).alias("amount"), F.col("p_type").alias("category"))
    )
    performance = reports.product_performance(sold, t.products)
    return rounded(performance, total_sales=2, avg_transaction=6, avg_product_price=6)


@query(
    "pl04_cohort_retention",
    """WITH c AS (SELECT customer_id, date_trunc('month', signup_date)::DATE AS cohort FROM customers),
       a AS (SELECT DISTINCT customer_id, date_trunc('month', transaction_date)::DATE AS month FROM transactions),
       s AS (SELECT cohort, count(*) AS cohort_size FROM c GROUP BY 1)
       SELECT strftime(cohort, '%Y-%m') AS signup_cohort, cohort_size, date_diff('month', cohort, month)::INT AS months_since_signup,
              count(DISTINCT customer_id) AS active_customers, round(count(DISTINCT customer_id) * 100.0 / cohort_size, 2)::DOUBLE AS retention_rate
       FROM a JOIN c USING (customer_id) JOIN s USING (cohort)
       WHERE date_diff('month', cohort, month) BETWEEN 0 AND 12 GROUP BY 1, 2, 3""",
    "transactions customers",
)
def cohort_retention(t):
    return reports.cohort_retention(t.transactions, t.customers)


@query(
    "pl05_sensor_health",
    """SELECT strftime(reading_date, '%Y-%m-%d') AS reading_date, location, status, round(v, 9) AS avg_value, min_value, max_value,
              reading_count, round(b, 9) AS avg_battery_level, round(g, 9) AS avg_signal_strength,
              CASE WHEN abs(v - avg(v) OVER w) > 2 * stddev_samp(v) OVER w THEN 'ANOMALY'
                   WHEN abs(v - avg(v) OVER w) > stddev_samp(v) OVER w THEN 'WARNING' ELSE 'NORMAL' END AS health_status
       FROM (SELECT timestamp::DATE AS reading_date, location, status, avg(value) AS v, min(value) AS min_value, max(value) AS max_value,
                    count(*) AS reading_count, avg(battery_level) AS b, avg(signal_strength) AS g FROM sensors GROUP BY 1, 2, 3)
       WINDOW w AS (PARTITION BY location, status)""",
    "sensors",
)
def sensor_health(t):
    health = rounded(reports.sensor_health(t.sensors), avg_value=9, avg_battery_level=9, avg_signal_strength=9)
    return health.withColumn("reading_date", day("reading_date"))


@query(
    "pl06_sensors_and_sales",
    """WITH r AS (SELECT timestamp::DATE AS day, location, avg(value) AS v FROM sensors WHERE status = 'active' GROUP BY 1, 2),
       s AS (SELECT (transaction_date + INTERVAL 9600 DAY)::DATE AS day,
                    sum(amount) AS daily_sales, count(*) AS n FROM transactions GROUP BY 1)
       SELECT CASE WHEN v > 75 THEN 'High' WHEN v > 25 THEN 'Medium' ELSE 'Low' END AS sensor_category, count(*) AS days_count,
              round(avg(daily_sales), 3) AS avg_daily_sales, round(avg(n), 6) AS avg_transactions, round(avg(v), 6) AS avg_sensor_reading
       FROM r JOIN s USING (day) GROUP BY 1""",
    "sensors transactions",
)
def sensors_and_sales(t):
    """The readings are from a later year, so the sales are moved to it."""
    moved = t.transactions.withColumn("transaction_date", F.col("transaction_date") + F.expr("INTERVAL 9600 DAY"))
    levels = reports.sensor_level_and_sales(t.sensors, moved)
    return rounded(levels, avg_daily_sales=3, avg_transactions=6, avg_sensor_reading=6)


@query(
    "pl07_customer_360",
    """SELECT c.customer_id, state, round(total_spent, 2) AS total_spent, transaction_count, categories_purchased,
              CASE WHEN total_spent > 5000 THEN 'VIP' WHEN total_spent > 2000 THEN 'High Value' WHEN total_spent > 500 THEN 'Medium Value'
                   ELSE 'Low Value' END AS customer_segment,
              date_diff('day', first_at::DATE, last_at::DATE)::INT AS days_as_customer, u.user_id IS NOT NULL AS has_social_presence,
              round(coalesce(CASE WHEN follower_count > 0 THEN following_count / follower_count * 100 WHEN u.user_id IS NOT NULL THEN 0.0 END, -1), 6)::DOUBLE
                AS engagement_rate, coalesce(verified, false) AS is_verified_user
       FROM customers c JOIN (SELECT customer_id, sum(amount) AS total_spent, count(*) AS transaction_count,
              count(DISTINCT category) AS categories_purchased, max(transaction_date) AS last_at, min(transaction_date) AS first_at
            FROM transactions GROUP BY 1) s ON c.customer_id = s.customer_id LEFT JOIN social u ON c.customer_id = u.user_id""",
    "customers transactions social",
)
def customer_360(t):
    followers = F.col("follower_count")
    # What the report shows of an account.
    presence = {
        "platform": F.lit("Social Platform"), "followers_count": followers, "posts_count": F.lit(0),
        "engagement_rate": F.when(followers > 0, F.col("following_count") / followers * 100).otherwise(0.0),
    }
    profile = cust.customer_360(t.customers, t.transactions, t.social, presence)
    return profile.select(
        "customer_id", "state", r("total_spent").alias("total_spent"), "transaction_count", "categories_purchased",
        "customer_segment", "days_as_customer", "has_social_presence",
        F.coalesce(r("engagement_rate", 6), F.lit(-1.0)).alias("engagement_rate"), "is_verified_user",
    )


@query(
    "pl08_shared_base",
    """WITH x AS (SELECT t.*, c.state, CASE WHEN total < 1000 THEN 'low' WHEN total < 5000 THEN 'medium' ELSE 'high' END AS segment,
                    CASE WHEN age < 25 THEN '18-25' WHEN age < 35 THEN '26-35' WHEN age < 45 THEN '36-45' ELSE '45+' END AS age_group
             FROM transactions t JOIN customers c USING (customer_id)
             JOIN (SELECT customer_id, sum(amount) AS total FROM transactions GROUP BY 1) USING (customer_id))
       SELECT 'segment' AS analysis, segment AS first_key, category AS second_key, round(sum(amount), 2) AS total_sales,
              count(*) AS transaction_count, round(avg(amount), 6) AS avg_amount FROM x GROUP BY 1, 2, 3
       UNION ALL SELECT 'geography', state, age_group, round(sum(amount), 2), count(*), round(avg(amount), 6) FROM x GROUP BY 1, 2, 3
       UNION ALL SELECT 'payment', segment, payment_method, round(sum(amount), 2), count(*), round(avg(amount), 6) FROM x GROUP BY 1, 2, 3""",
    "transactions customers",
)
def shared_base(t):
    result = None
    for name, df in cust.shared_analyses(t.transactions, t.customers).items():
        first, second = cust.SHARED_ANALYSES[name]
        part = df.select(
            F.lit(name).alias("analysis"), F.col(first).alias("first_key"), F.col(second).alias("second_key"),
            r("total_sales").alias("total_sales"), "transaction_count", r("avg_amount", 6).alias("avg_amount"),
        )
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "pl08b_transaction_features",
    """SELECT transaction_id, amount > mean AS is_high_value, round(amount / total, 9) AS customer_lifetime_ratio
       FROM transactions JOIN customers USING (customer_id)
       JOIN (SELECT customer_id, avg(amount) AS mean, sum(amount) AS total FROM transactions GROUP BY 1) USING (customer_id)""",
    "transactions customers",
)
def transaction_features(t):
    features = cust.against_customer(t.transactions, t.customers)
    return features.select("transaction_id", "is_high_value", r("customer_lifetime_ratio", 9).alias("customer_lifetime_ratio"))


@query(
    "pl09_segment_analysis",
    """SELECT state, category, round(sum(amount), 2) AS total, round(avg(amount), 6) AS average
       FROM transactions JOIN customers USING (customer_id) WHERE amount >= 150 GROUP BY 1, 2 ORDER BY sum(amount) DESC, 1, 2 LIMIT 10""",
    "transactions customers",
)
def segment_analysis(t):
    """The ten largest are the report."""
    return rounded(cust.largest_totals(cust.state_category_totals(t.transactions, t.customers, 150), "total", 10), total=2, average=6)


@query(
    "pl10_executive_report",
    """WITH top AS (SELECT franchise_id, sum(total_price) AS revenue, count(*) AS transaction_count,
                      count(DISTINCT customer_id) AS unique_customers, avg(total_price) AS mean FROM sales GROUP BY 1
                    ORDER BY revenue DESC, 1 LIMIT 5)
       SELECT franchise_id, round(revenue, 2) AS total_revenue, transaction_count, unique_customers,
              round(mean, 2) AS avg_transaction_value, name AS franchise_name, city AS franchise_city, country,
              round(revenue / unique_customers, 2) AS avg_spend_per_customer,
              (SELECT CASE WHEN lower(payment_method) IN ('visa', 'mastercard', 'amex') THEN 'Credit Card' ELSE 'Other' END AS c
               FROM sales GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1) AS most_popular_payment_category,
              (SELECT strftime(sold_at, '%A') FROM sales GROUP BY 1 ORDER BY sum(total_price) DESC LIMIT 1) AS highest_revenue_day_of_week
       FROM top LEFT JOIN franchises USING (franchise_id)""",
    "sales franchises",
)
def executive_report(t):
    return rounded(franchises.executive_report(t.sales, t.franchises), total_revenue=2)


@query(
    "pl11_performance_report",
    """SELECT franchise_id, f.name, f.city, country, round(sum(total_price), 2) AS total_revenue, count(transaction_id) AS transaction_count,
              count(DISTINCT s.customer_id) AS unique_customers
       FROM sales s JOIN customers c ON s.customer_id = c.customer_id JOIN franchises f USING (franchise_id)
       WHERE country = 'ASIA' GROUP BY 1, 2, 3, 4""",
    "sales customers franchises",
)
def performance_report(t):
    return rounded(franchises.performance_report(t.sales, t.customers, t.franchises, "ASIA"), total_revenue=2)


CLEAN_TRIPS = """
    SELECT *, dayofweek(started) + 1 AS dow FROM (
      SELECT *, try_cast(started_at AS TIMESTAMP) AS started, try_cast(ended_at AS TIMESTAMP) AS ended,
             start_lat::DOUBLE AS slat, start_lng::DOUBLE AS slng, end_lat::DOUBLE AS elat, end_lng::DOUBLE AS elng FROM trips_raw)
    WHERE started IS NOT NULL AND ended IS NOT NULL AND start_station_name IS NOT NULL AND end_station_name IS NOT NULL
      AND epoch(ended) - epoch(started) > 0 AND epoch(ended) - epoch(started) < 86400
      AND slat BETWEEN -90 AND 90 AND slng BETWEEN -180 AND 180 AND elat BETWEEN -90 AND 90 AND elng BETWEEN -180 AND 180
"""
STATION = "NATION_3"


@query(
    "pl12_station_connections",
    f"""WITH c AS ({CLEAN_TRIPS}),
        d AS (SELECT end_station_name AS s, count(*) AS n, avg(elat) AS la, avg(elng) AS lo FROM c WHERE start_station_name = '{STATION}' GROUP BY 1),
        a AS (SELECT start_station_name AS s, count(*) AS n, avg(slat) AS la, avg(slng) AS lo FROM c WHERE end_station_name = '{STATION}' GROUP BY 1)
        SELECT coalesce(d.s, a.s) AS other_station, round(coalesce(d.la, a.la), 6) AS lat, round(coalesce(d.lo, a.lo), 6) AS lng,
               coalesce(d.n, 0) AS departure_count, coalesce(a.n, 0) AS arrival_count, coalesce(d.n, 0) + coalesce(a.n, 0) AS total_trips,
               coalesce(d.n, 0) - coalesce(a.n, 0) AS net_flow, '{STATION}' AS target_station,
               (SELECT round(avg(slat), 6) FROM c WHERE start_station_name = '{STATION}') AS t_lat,
               (SELECT round(avg(slng), 6) FROM c WHERE start_station_name = '{STATION}') AS t_lng
        FROM d FULL JOIN a ON d.s = a.s""",
    "trips_raw",
)
def station_connections(t):
    flows = trips.station_connections(trips.clean_trips(t.trips_raw), STATION)
    return rounded(flows, lat=6, lng=6, t_lat=6, t_lng=6)


@query(
    "pl13_hourly_counts",
    f"""WITH c AS ({CLEAN_TRIPS}),
        d AS (SELECT dow, strftime(started, '%a') AS l, hour(started) AS h, count(*) AS n FROM c WHERE start_station_name = '{STATION}' GROUP BY 1, 2, 3),
        a AS (SELECT dayofweek(ended) + 1 AS dow, strftime(ended, '%a') AS l, hour(ended) AS h, count(*) AS n FROM c
              WHERE end_station_name = '{STATION}' GROUP BY 1, 2, 3)
        SELECT coalesce(d.dow, a.dow)::INT AS day_of_week, coalesce(d.l, a.l) AS day_label, coalesce(d.h, a.h)::INT AS hour,
               coalesce(d.n, 0) AS departure_count, coalesce(a.n, 0) AS arrival_count, coalesce(d.n, 0) + coalesce(a.n, 0) AS total_count,
               '{STATION}' AS target_station FROM d FULL JOIN a ON d.dow = a.dow AND d.h = a.h""",
    "trips_raw",
)
def hourly_counts(t):
    return trips.hourly_counts(trips.clean_trips(t.trips_raw), STATION)


HEATMAP_HOURS = ", ".join(f"count(*) FILTER (WHERE h = {h}) AS h{h}" for h in range(24))


@query(
    "pl13b_departure_heatmap",
    f"""WITH c AS ({CLEAN_TRIPS}) SELECT l AS day_label, {HEATMAP_HOURS} FROM (
          SELECT strftime(started, '%a') AS l, hour(started) AS h FROM c WHERE start_station_name = '{STATION}') GROUP BY 1""",
    "trips_raw",
)
def departure_heatmap(t):
    heat = trips.departure_heatmap(trips.hourly_counts(trips.clean_trips(t.trips_raw), STATION))
    return heat.select("day_label", *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h}") for h in range(24)])


WEEKS = f"""
    SELECT coalesce(d.w, a.w) AS week_start, coalesce(d.n, 0) AS departures, coalesce(a.n, 0) AS arrivals
    FROM (SELECT date_trunc('week', started) AS w, count(*) AS n FROM c WHERE start_station_name = '{STATION}' GROUP BY 1) d
    FULL JOIN (SELECT date_trunc('week', ended) AS w, count(*) AS n FROM c WHERE end_station_name = '{STATION}' GROUP BY 1) a ON d.w = a.w
"""


@query(
    "pl14_weekly_counts",
    f"""WITH c AS ({CLEAN_TRIPS}) SELECT strftime(week_start, '%Y-%m-%d') AS week_start, departures, arrivals,
               departures + arrivals AS total_trips, '{STATION}' AS target_station FROM ({WEEKS})""",
    "trips_raw",
)
def weekly_counts(t):
    weeks = trips.weekly_counts(trips.clean_trips(t.trips_raw), STATION)
    return weeks.withColumn("week_start", day("week_start"))


@query(
    "pl14b_monthly_counts",
    f"""WITH c AS ({CLEAN_TRIPS}) SELECT strftime(date_trunc('month', week_start), '%Y-%m-%d') AS month,
               sum(departures)::BIGINT AS departures, sum(arrivals)::BIGINT AS arrivals FROM ({WEEKS}) GROUP BY 1""",
    "trips_raw",
)
def monthly_counts(t):
    weeks = trips.weekly_counts(trips.clean_trips(t.trips_raw), STATION)
    return trips.monthly_counts(weeks).withColumn("month", day("month"))


@query(
    "pl15_clean_trips",
    f"""SELECT ride_id, strftime(started, '%Y-%m-%d %H:%M:%S') AS started_at, (epoch(ended) - epoch(started))::BIGINT AS duration_seconds,
               strftime(started, '%Y-%m-%d') AS start_date, hour(started)::INT AS start_hour, hour(ended)::INT AS end_hour,
               dow::INT AS day_of_week, strftime(started, '%a') AS day_label, strftime(date_trunc('week', started), '%Y-%m-%d') AS week_start,
               dow IN (1, 7) AS is_weekend FROM ({CLEAN_TRIPS})""",
    "trips_raw",
)
def clean_trips(t):
    return trips.clean_trips(t.trips_raw).select(
        "ride_id", stamp("started_at").alias("started_at"), "duration_seconds", day("start_date").alias("start_date"),
        "start_hour", "end_hour", "day_of_week", "day_label", day("week_start").alias("week_start"), "is_weekend",
    )


MENTION_ROWS = """
    SELECT *, lower(unnest(CASE WHEN len(found) = 0 THEN [NULL] ELSE found END)) AS mention FROM (
      SELECT *, regexp_extract_all(text, '@[\\p{L}\\p{N}_]+') AS found,
             CASE WHEN doc_id % 41 = 0 THEN NULL ELSE TIMESTAMP '2009-04-06 22:19:45' + to_minutes(doc_id::INT) END AS posted_at
      FROM posts)
"""


@query(
    "pl16_mention_rows",
    f"""SELECT strftime(posted_at, '%Y-%m-%d %H:%M:%S') AS timestamp, mention, regexp_replace(text, '@\\S+', '', 'g') AS cleaned_text,
               text, sentiment FROM ({MENTION_ROWS})""",
    "posts",
)
def mention_rows(t):
    return posts.mention_rows(t.posts).withColumn("timestamp", stamp("timestamp"))


def scored_posts(t, *also):
    """Mention rows with a score that follows from the text, in place of a model."""
    label = F.when(F.length("cleaned_text") % 3 == 0, "NEGATIVE").when(F.length("cleaned_text") % 3 == 1, "POSITIVE").otherwise("NEUTRAL")
    rows = posts.mention_rows(t.posts, *also).withColumn(
        "scored", F.struct(label.alias("label"), (F.length("cleaned_text") % 100 / 100.0).alias("score"))
    )
    return posts.with_sentiment_ids(rows)


SCORED_POSTS = f"""
    SELECT *, CASE length(cleaned) % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' ELSE 'neutral' END AS predicted
    FROM (SELECT *, regexp_replace(text, '@\\S+', '', 'g') AS cleaned FROM ({MENTION_ROWS}))
"""


@query(
    "pl17_sentiment_by_mention",
    f"""SELECT mention, count(*) FILTER (WHERE predicted = 'positive') AS positive, count(*) FILTER (WHERE predicted = 'negative') AS negative,
               count(*) FILTER (WHERE predicted IN ('positive', 'negative')) AS total,
               strftime(min(posted_at), '%Y-%m-%d %H:%M:%S') AS min_timestamp, strftime(max(posted_at), '%Y-%m-%d %H:%M:%S') AS max_timestamp
        FROM ({SCORED_POSTS}) WHERE mention IS NOT NULL GROUP BY 1""",
    "posts",
)
def sentiment_by_mention(t):
    result = posts.sentiment_by_mention(scored_posts(t))
    return result.withColumns({c: stamp(c) for c in ("min_timestamp", "max_timestamp")})


@query(
    "pl18_binary_ids",
    f"""SELECT coalesce(sentiment, 'none') AS sentiment, predicted AS predicted_sentiment, CASE WHEN sentiment = '0' THEN 0 ELSE 1 END AS sentiment_id,
               CASE WHEN predicted = 'negative' THEN 0 ELSE 1 END AS predicted_sentiment_id, count(*) AS row_count
        FROM ({SCORED_POSTS}) GROUP BY 1, 2, 3, 4""",
    "posts",
)
def binary_ids(t):
    keyed = scored_posts(t).withColumn("sentiment", F.coalesce("sentiment", F.lit("none")))
    keys = ("sentiment", "predicted_sentiment", "sentiment_id", "predicted_sentiment_id")
    return keyed.groupBy(*keys).agg(F.count("*").alias("row_count"))


@query(
    "pl19_order_facts",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, n_name AS region, count(*) AS order_count,
              round(sum(o_totalprice), 2) AS total_revenue, count(DISTINCT o_custkey) AS unique_customers
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN customers ON c_custkey = customer_id WHERE email IS NOT NULL GROUP BY 1, 2""",
    "customers",
)
def order_facts(t):
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("int").alias("customer_id"),
        F.lit("p").alias("product_id"), F.lit(1).alias("quantity"), F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.col("o_orderdate").alias("order_date"),
    )
    people = t.customers.select(
        F.col("customer_id").cast("int").alias("customer_id"), F.when(F.col("email").isNotNull(), F.col("name")).alias("name"),
        "email", F.col("state").alias("region"), "signup_date",
    )
    summary = orders.per_day_and_region(orders.with_customers(raw, people))
    return summary.withColumns({"order_date": day("order_date"), "total_revenue": r(F.col("total_revenue").cast("double"))})


@query(
    "pl20_trip_features",
    """SELECT pickup_zip, dropoff_zip, fare_amount, hour(pickup_at)::INT AS pickup_hour, (isodow(pickup_at) - 1)::INT AS pickup_day_of_week,
              (isodow(pickup_at) >= 6)::INT AS is_weekend, round(m, 6)::DOUBLE AS trip_duration_minutes,
              round(trip_distance / (m / 60.0), 6)::DOUBLE AS avg_speed_mph
       FROM (SELECT *, (epoch(dropoff_at) - epoch(pickup_at)) / 60.0 AS m FROM taxi)
       WHERE fare_amount > 0 AND trip_distance > 0 AND m > 0 AND trip_distance / (m / 60.0) > 0 AND trip_distance / (m / 60.0) < 80""",
    "taxi",
)
def trip_features(t):
    features = taxi.valid_features(taxi.with_features(t.taxi)).drop("pickup_at", "dropoff_at", "trip_distance")
    return rounded(features, trip_duration_minutes=6, avg_speed_mph=6)


@query(
    "pl21_prediction_errors",
    """SELECT l_orderkey, l_linenumber, round(guess - price, 4) AS prediction_error, round(abs(guess - price), 4) AS absolute_error,
              round(abs(guess - price) / price * 100, 6) AS percentage_error
       FROM (SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_quantity * 1000 AS guess FROM lineitem)""",
)
def prediction_errors(t):
    guessed = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), (F.col("l_quantity") * 1000).alias("guess")
    )
    errors = evaluation.with_errors(guessed, "price", "guess").drop("price", "guess")
    return rounded(errors, prediction_error=4, absolute_error=4, percentage_error=6)


@query(
    "pl22_counters",
    f"""SELECT 'total_posts' AS metric, count(*) AS value FROM posts
        UNION ALL SELECT 'with_mentions', count(mention) FROM ({MENTION_ROWS})
        UNION ALL SELECT 'without_mentions', count(*) FROM ({MENTION_ROWS}) WHERE mention IS NULL""",
    "posts",
)
def counters(t):
    return posts.counters(t.posts)


@query(
    "pl22b_top_lists",
    f"""SELECT * FROM (SELECT 'users' AS list, "user" AS label, count(*) AS value FROM posts GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
        UNION ALL SELECT * FROM (SELECT 'positive', mention, count(*) FILTER (WHERE predicted = 'positive') AS v FROM ({SCORED_POSTS})
                                 WHERE mention IS NOT NULL GROUP BY 2 ORDER BY v DESC, 2 LIMIT 10)
        UNION ALL SELECT * FROM (SELECT 'negative', mention, count(*) FILTER (WHERE predicted = 'negative') AS v FROM ({SCORED_POSTS})
                                 WHERE mention IS NOT NULL GROUP BY 2 ORDER BY v DESC, 2 LIMIT 10)""",
    "posts",
)
def top_lists(t):
    return posts.top_lists(scored_posts(t, "user", "first_of_post"))


@query(
    "pl23_high_growth",
    """SELECT customer_id, count(*) AS high_growth_months, round(avg(g), 4) AS avg_growth_rate FROM (
         SELECT customer_id, (total / lag(total) OVER (PARTITION BY customer_id ORDER BY y, m) - 1) * 100 AS g FROM (
           SELECT customer_id, year(transaction_date) AS y, month(transaction_date) AS m, sum(amount) AS total FROM transactions GROUP BY 1, 2, 3))
       WHERE g > 50 GROUP BY 1 HAVING count(*) >= 2""",
    "transactions",
)
def high_growth(t):
    growth = windows.running_growth(cust.monthly_by_customer(t.transactions), "customer_id", ["year", "month"], "monthly_total")
    return rounded(cust.high_growth_customers(growth), avg_growth_rate=4)


@query(
    "pl24_taxed_spending",
    """SELECT customer_id, round(sum(amount * CASE WHEN category = '1-URGENT' THEN 1.08 ELSE 1.06 END), 3) AS total_spent,
              count(*) AS transaction_count FROM transactions GROUP BY 1
       HAVING sum(amount * CASE WHEN category = '1-URGENT' THEN 1.08 ELSE 1.06 END) > 500000 AND count(*) > 2""",
    "transactions",
)
def taxed_spending(t):
    taxed = cust.taxed_spending(t.transactions, "1-URGENT", 0.08, 0.06, 500_000, 2)
    return rounded(taxed, total_spent=3)


@query(
    "pl25_state_and_category",
    """SELECT state, category, round(sum(amount), 2) AS total_amount, count(*) AS transaction_count
       FROM customers JOIN transactions USING (customer_id) WHERE age BETWEEN 25 AND 65 AND amount > 50
       GROUP BY 1, 2 HAVING sum(amount) > 1000000""",
    "transactions customers",
)
def state_and_category(t):
    target = t.customers.filter("age BETWEEN 25 AND 65")
    by_state = cust.sales_by_state_and_category(t.transactions.filter("amount > 50"), target)
    return rounded(by_state.filter("total_amount > 1000000"), total_amount=2)


@query(
    "pl26_payment_analysis",
    """SELECT state, payment_method, round(sum(amount), 2) AS total_amount, round(avg(amount), 6) AS avg_amount, count(*) AS transaction_count
       FROM customers JOIN transactions USING (customer_id) WHERE age BETWEEN 25 AND 45 GROUP BY 1, 2 HAVING sum(amount) > 10000""",
    "transactions customers",
)
def payment_analysis(t):
    return rounded(cust.payment_analysis(t.transactions, t.customers), total_amount=2, avg_amount=6)


@query(
    "pl27_transaction_columns",
    """SELECT transaction_id, CASE WHEN amount < 50 THEN 'Low' WHEN amount < 200 THEN 'Medium' ELSE 'High' END AS amount_category,
              strftime(transaction_date, '%Y-%m') AS transaction_month,
              coalesce(CASE is_weekend WHEN 'true' THEN 'yes' WHEN 'false' THEN 'no' END, 'unknown') AS weekend, round(amount, 2) AS amount_usd,
              hour(transaction_date)::INT AS transaction_hour, date_diff('day', transaction_date::DATE, DATE '2002-01-01')::INT AS days_since_transaction
       FROM transactions""",
    "transactions",
)
def transaction_columns(t):
    columns = cust.transaction_columns(t.transactions, F.lit("2002-01-01").cast("date"))
    weekend = F.when(F.col("is_weekend_bool"), "yes").when(~F.col("is_weekend_bool"), "no").otherwise("unknown")
    return columns.select(
        "transaction_id", "amount_category", "transaction_month", weekend.alias("weekend"), "amount_usd",
        "transaction_hour", "days_since_transaction",
    )


@query(
    "pl28_weekday_revenue",
    """SELECT strftime(sold_at, '%a') AS day_of_week, round(sum(total_price), 2) AS total_revenue FROM sales GROUP BY 1
       UNION ALL SELECT pickup_zip || '@' || hour(pickup_at), round(sum(fare_amount), 2) FROM taxi GROUP BY 1""",
    "sales taxi",
)
def weekday_revenue(t):
    by_day = franchises.revenue_by_weekday(t.sales)
    by_zone = t.spark.sql(
        """SELECT concat(pickup_zip, '@', hour(pickup_at)) AS day_of_week, sum(fare_amount) AS total_revenue
           FROM {taxi} GROUP BY day_of_week""",
        taxi=t.taxi,
    )
    return rounded(by_day.unionByName(by_zone), total_revenue=2)


@query(
    "pt05_filter_order",
    """SELECT transaction_id, round(amount * 1.08, 4) AS total_with_tax, upper(category) AS category_upper FROM transactions
       WHERE amount > 200000 AND category = '2-HIGH'""",
    "transactions",
)
def filter_order(t):
    taxed = t.transactions.select(
        "transaction_id", "amount", "category", r(F.col("amount") * 1.08, 4).alias("total_with_tax"),
        F.upper("category").alias("category_upper"),
    )
    return taxed.filter("amount > 200000").filter("category = '2-HIGH'").drop("amount", "category")


@query(
    "pl29_amount_categories",
    """SELECT state, CASE WHEN amount < 50 THEN 'low' WHEN amount < 200 THEN 'medium' ELSE 'high' END AS amount_category,
              round(sum(amount), 2) AS total_amount, count(*) AS transaction_count
       FROM transactions JOIN customers USING (customer_id) GROUP BY 1, 2""",
    "transactions customers",
)
def amount_categories(t):
    return rounded(cust.amount_category_analysis(t.transactions, t.customers), total_amount=2)
