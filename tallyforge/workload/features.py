"""Feature columns, and functions callable from SQL."""

from pyspark.sql import functions as F

from tallyforge.functions import scores, text, tiers, times, validation
from tallyforge.functions.registry import register_python, register_sql_functions
from tallyforge.operators.skew import salted_join
from tallyforge.plans import customers as customer_plans
from tallyforge.workload.registry import query, r, rounded

TOTALS = """
    SELECT customer_id, sum(amount) / 1000 AS total_spent, count(*) AS transaction_count, avg(amount) / 1000 AS avg_amount
    FROM transactions GROUP BY 1
"""


def totals(t):
    """Customer totals in thousands, the size the scores are made for."""
    return t.transactions.groupBy("customer_id").agg(
        (F.sum("amount") / 1000).alias("total_spent"), F.count("*").alias("transaction_count"),
        (F.avg("amount") / 1000).alias("avg_amount"),
    )


@query(
    "ud01_class_columns",
    """SELECT s.transaction_id, s.product, s.quantity,
              CASE WHEN lower(s.payment_method) IN ('visa', 'mastercard', 'amex') THEN 'Credit Card' ELSE 'Other' END AS payment_category,
              CASE WHEN s.quantity < 20 THEN 'Small' WHEN s.quantity <= 50 THEN 'Medium' ELSE 'Large' END AS transaction_size,
              CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 25 THEN 'Gen Z' WHEN age < 40 THEN 'Millennial'
                   WHEN age < 55 THEN 'Gen X' ELSE 'Boomer' END AS generation,
              CASE WHEN age IS NULL THEN 'unknown' WHEN s.total_price > 1000 THEN 'high' WHEN s.total_price > 100 THEN 'medium'
                   ELSE 'low' END AS amount_class
       FROM sales s JOIN customers USING (customer_id)""",
    "sales customers",
)
def class_columns(t):
    joined = t.sales.join(t.customers.select("customer_id", "age"), "customer_id").withColumn(
        "known_price", F.when(F.col("age").isNotNull(), F.col("total_price"))
    )
    return joined.select(
        "transaction_id", "product", "quantity", tiers.payment_category("payment_method").alias("payment_category"),
        tiers.transaction_size("quantity").alias("transaction_size"), tiers.generation("age").alias("generation"),
        tiers.amount_class("known_price").alias("amount_class"),
    )


@query(
    "ud02_risk",
    f"""SELECT customer_id, CASE WHEN age IS NULL OR total_spent IS NULL OR transaction_count IS NULL THEN 'Unknown'
               WHEN score >= 15 THEN 'High' WHEN score >= 8 THEN 'Medium' ELSE 'Low' END AS risk_category
        FROM (SELECT *, CASE WHEN age < 25 THEN 5 WHEN age > 65 THEN 3 ELSE 0 END
                + CASE WHEN total_spent / greatest(transaction_count, 1) > 1000
                         OR total_spent / greatest(transaction_count, 1) < 10 THEN 4 ELSE 0 END
                + CASE WHEN transaction_count < 3 THEN 6 WHEN transaction_count > 50 THEN 2 ELSE 0 END
                + CASE WHEN state IN ('NATION_1', 'NATION_5', 'NATION_9') THEN 2 ELSE 0 END AS score
              FROM customers LEFT JOIN (SELECT customer_id, total_spent / (1 + customer_id % 40) AS total_spent,
                     CASE WHEN customer_id % 9 = 0 THEN 2 ELSE transaction_count END AS transaction_count
                   FROM ({TOTALS})) USING (customer_id))""",
    "customers transactions",
)
def risk(t):
    varied = totals(t).withColumns(
        {
            "total_spent": F.col("total_spent") / (1 + F.col("customer_id") % 40),
            "transaction_count": F.when(F.col("customer_id") % 9 == 0, 2).otherwise(F.col("transaction_count")),
        }
    )
    category = scores.risk_category(
        "age", "total_spent", "transaction_count", "state", ("NATION_1", "NATION_5", "NATION_9")
    )
    return t.customers.join(varied, "customer_id", "left").select("customer_id", category.alias("risk_category"))


@query(
    "ud03_email_class",
    """SELECT customer_id, CASE WHEN email IS NULL OR NOT contains(email, '@') THEN 'Unknown'
              WHEN d IN ('company.com', 'corp.com', 'business.com', 'enterprise.com') OR contains(d, 'corp')
                OR contains(d, 'company') THEN 'Business'
              WHEN d IN ('gmail.com', 'yahoo.com', 'hotmail.com', 'outlook.com', 'aol.com') THEN 'Consumer'
              WHEN contains(d, 'edu') THEN 'Educational' WHEN d LIKE '%.gov' THEN 'Government' ELSE 'Other' END AS email_class
       FROM (SELECT *, lower(split_part(email, '@', 2)) AS d FROM customers)""",
    "customers",
)
def email_class(t):
    return t.customers.select("customer_id", tiers.email_class("email").alias("email_class"))


@query(
    "ud04_anomaly",
    """SELECT transaction_id, coalesce(CASE WHEN s = 0 THEN abs(amount - m) > m * 0.5 ELSE abs(amount - m) / s > 2 END, false)
              AS is_anomaly
       FROM (SELECT *, CASE WHEN transaction_id % 50 <> 0 THEN customer_id END AS buyer FROM transactions)
       LEFT JOIN (SELECT CASE WHEN transaction_id % 50 <> 0 THEN customer_id END AS buyer, avg(amount) AS m, stddev_samp(amount) AS s
                  FROM transactions GROUP BY 1) USING (buyer)""",
    "transactions",
)
def anomaly(t):
    """Some transactions have no customer; they are kept and are no anomaly."""
    known = t.transactions.withColumn("customer_id", F.when(F.col("transaction_id") % 50 != 0, F.col("customer_id")))
    stats = customer_plans.profiles(known, "avg_amount", "std_amount")
    joined = salted_join(known, stats, ["customer_id"], ["transaction_id"], "left")
    return joined.select("transaction_id", scores.is_anomaly("amount", "avg_amount", "std_amount").alias("is_anomaly"))


@query(
    "ud05_from_sql",
    """SELECT customer_id, CASE WHEN age < 25 THEN 'Young Adult' WHEN age < 35 THEN 'Adult' WHEN age < 50 THEN 'Middle Age'
              ELSE 'Senior' END AS age_category, upper(name) || '!' AS shout FROM customers""",
    "customers",
)
def from_sql(t):
    register_sql_functions(t.spark)
    register_python(t.spark, "shout", lambda value: None if value is None else value.upper() + "!", "string")
    return t.spark.sql(
        "SELECT customer_id, categorize_age(age) AS age_category, shout(name) AS shout FROM {customers}",
        customers=t.customers,
    )


@query(
    "ud06_labels",
    f"""SELECT customer_id, name || ' (' || state || ')' AS customer_label,
               CASE WHEN total_spent > 150 THEN 'High Spender' WHEN total_spent > 75 THEN 'Regular' ELSE 'Low Spender' END AS tier
        FROM customers JOIN ({TOTALS}) USING (customer_id)""",
    "customers transactions",
)
def labels(t):
    label = F.concat("name", F.lit(" ("), "state", F.lit(")"))
    return t.customers.join(totals(t), "customer_id").select(
        "customer_id", label.alias("customer_label"), tiers.customer_tier("total_spent").alias("tier")
    )


@query(
    "ud07_mentions",
    """SELECT doc_id, len(regexp_extract_all(text, '@[\\p{L}\\p{N}_]+'))::INT AS mention_count,
              regexp_replace(text, '@\\S+', '', 'g') AS cleaned_text FROM posts""",
    "posts",
)
def mentions(t):
    return t.posts.select(
        "doc_id", F.size(text.mentions("text")).alias("mention_count"), text.without_mentions("text").alias("cleaned_text")
    )


@query(
    "ud08_loyalty_score",
    f"""SELECT customer_id, round(greatest(0, least(n / 10, 1.0) * 30 + least(s / 5000, 1.0) * 40 + least(d / 365, 1.0) * 20
               + CASE WHEN m > 0 THEN (1 - abs(m - 100) / 100) * 10 ELSE 0 END), 6)::DOUBLE AS loyalty
        FROM (SELECT customer_id, coalesce(transaction_count, 0)::DOUBLE AS n, coalesce(total_spent, 0)::DOUBLE AS s,
                     coalesce(avg_amount, 0)::DOUBLE AS m, date_diff('day', signup_date, DATE '1995-10-01')::DOUBLE AS d
              FROM customers LEFT JOIN ({TOTALS}) USING (customer_id))""",
    "customers transactions",
)
def loyalty_score(t):
    days = F.datediff(F.lit("1995-10-01").cast("date"), "signup_date")
    joined = t.customers.withColumn("days", days).join(totals(t), "customer_id", "left")
    score = scores.loyalty_score("transaction_count", "total_spent", "days", "avg_amount")
    return joined.select("customer_id", r(score, 6).alias("loyalty"))


@query(
    "ud09_loyalty_points",
    f"""SELECT customer_id, trunc(least(transaction_count * 10, 40) + least(total_spent / 100 / 10, 40) + least(avg_amount / 10, 20))::INT
               AS points FROM ({TOTALS})""",
    "transactions",
)
def loyalty_points(t):
    register_sql_functions(t.spark)
    return t.spark.sql(
        "SELECT customer_id, loyalty_points(transaction_count, total_spent / 100, avg_amount) AS points FROM {totals}",
        totals=totals(t),
    )


@query(
    "ud10_time_features",
    """SELECT pickup_zip, dropoff_zip, coalesce(hour(p), 0)::INT AS hour, coalesce(isodow(p) - 1, 0)::INT AS day_of_week,
              (coalesce(isodow(p) - 1, 0) >= 5)::INT AS is_weekend
       FROM (SELECT *, CASE WHEN trip_distance < 0 THEN NULL ELSE pickup_at END AS p FROM taxi)""",
    "taxi",
)
def time_features(t):
    known = t.taxi.withColumn("p", F.when(F.col("trip_distance") >= 0, F.col("pickup_at")))
    return known.select("pickup_zip", "dropoff_zip", times.time_features("p").alias("f")).select("pickup_zip", "dropoff_zip", "f.*")


@query(
    "ud11_trip_metrics",
    """SELECT pickup_zip, dropoff_zip, round(m, 6)::DOUBLE AS trip_duration_minutes,
              round(CASE WHEN m > 0 THEN trip_distance / (m / 60.0) ELSE 0.0 END, 6)::DOUBLE AS avg_speed_mph
       FROM (SELECT *, (epoch(dropoff_at) - epoch(pickup_at)) / 60.0 AS m FROM taxi)""",
    "taxi",
)
def trip_metrics(t):
    metrics = times.trip_metrics("pickup_at", "dropoff_at", "trip_distance")
    flat = t.taxi.select("pickup_zip", "dropoff_zip", metrics.alias("m")).select("pickup_zip", "dropoff_zip", "m.*")
    return rounded(flat, trip_duration_minutes=6, avg_speed_mph=6)


RFM = """
    SELECT customer_id, date_diff('day', max(transaction_date)::DATE, DATE '2002-01-01')::INT AS days_since_last,
           count(*) AS frequency, round(sum(amount), 2) AS monetary FROM transactions GROUP BY 1
"""


@query(
    "ud12_rfm",
    f"""WITH base AS ({RFM}), cuts AS (SELECT quantile_disc(days_since_last, [0.2, 0.4, 0.6, 0.8]) AS rc,
               quantile_disc(frequency, [0.2, 0.4, 0.6, 0.8]) AS fc, quantile_disc(monetary, [0.2, 0.4, 0.6, 0.8]) AS mc FROM base),
        s AS (SELECT customer_id,
                (5 - len(list_filter(rc, lambda c: days_since_last > c)))::INT AS recency_score,
                (1 + len(list_filter(fc, lambda c: frequency > c)))::INT AS frequency_score,
                (1 + len(list_filter(mc, lambda c: monetary > c)))::INT AS monetary_score FROM base, cuts)
        SELECT *, CASE WHEN least(recency_score, frequency_score, monetary_score) >= 4 THEN 'Champions'
                 WHEN least(recency_score, frequency_score, monetary_score) >= 3 THEN 'Loyal Customers'
                 WHEN recency_score >= 4 AND frequency_score <= 2 THEN 'New Customers'
                 WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'At Risk'
                 WHEN recency_score <= 2 THEN 'Lost Customers' ELSE 'Potential Loyalists' END AS rfm_segment FROM s""",
    "transactions",
)
def rfm(t):
    base = t.transactions.groupBy("customer_id").agg(
        F.datediff(F.lit("2002-01-01").cast("date"), F.max("transaction_date")).alias("days_since_last"),
        F.count("*").alias("frequency"), r(F.sum("amount")).alias("monetary"),
    )
    return scores.rfm_scores(base, "days_since_last", "frequency", "monetary").drop("days_since_last", "frequency", "monetary")


@query(
    "ud13_series_shape",
    """WITH m AS (SELECT customer_id, date_trunc('month', transaction_date) AS month,
                         CAST(sum(CAST(amount AS DECIMAL(12,2))) AS DECIMAL(18,2))::DOUBLE / 1000 AS v FROM transactions GROUP BY 1, 2),
       p AS (SELECT customer_id, CAST(v AS DECIMAL(18,5))::DOUBLE AS v,
                    row_number() OVER (PARTITION BY customer_id ORDER BY month) - 1 AS x FROM m),
       s AS (SELECT customer_id, count(*) AS n, avg(v) AS mean, stddev_pop(v) AS sd, regr_slope(v, x) AS slope FROM p GROUP BY 1)
       SELECT customer_id, round(CASE WHEN n >= 3 THEN sd / mean ELSE 0 END, 6)::DOUBLE AS seasonality_index,
              CASE WHEN n >= 3 AND slope > 5 THEN 'increasing' WHEN n >= 3 AND slope < -5 THEN 'decreasing' ELSE 'stable' END
                AS trend_direction,
              round(CASE WHEN n >= 3 THEN sd / mean ELSE 0 END, 6)::DOUBLE AS volatility_score FROM s""",
    "transactions",
)
def series_shape(t):
    """The list of a customer holds one number per month: at most as many as there are months."""
    monthly = t.transactions.groupBy("customer_id", F.trunc("transaction_date", "MM").alias("month")).agg(
        F.sum(F.col("amount").cast("decimal(12,2)")).cast("decimal(18,2)").cast("double").alias("v")
    )
    shown = (F.col("v") / 1000).cast("decimal(18,5)").cast("string")
    lists = monthly.groupBy("customer_id").agg(
        F.sort_array(F.collect_list(F.struct("month", shown.alias("shown")))).alias("points")
    )
    texts = lists.select("customer_id", F.array_join("points.shown", ",").alias("monthly_amounts"))
    return rounded(
        validation.series_shape(texts, "customer_id", "monthly_amounts"), seasonality_index=6, volatility_score=6
    )


@query(
    "ud14_text_features",
    """WITH w AS (SELECT doc_id, lower(text) AS low, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS words
                  FROM posts),
       s AS (SELECT *, len(words) AS n,
               contains(low, 'good')::INT + contains(low, 'great')::INT + contains(low, 'excellent')::INT
               + contains(low, 'amazing')::INT + contains(low, 'love')::INT + contains(low, 'best')::INT
               - contains(low, 'bad')::INT - contains(low, 'terrible')::INT - contains(low, 'awful')::INT
               - contains(low, 'hate')::INT - contains(low, 'worst')::INT - contains(low, 'horrible')::INT AS score FROM w)
       SELECT doc_id, round(score / greatest(n, 1), 9) AS sentiment_score,
              len(list_filter(words, lambda x: regexp_matches(x, '^\\p{Lu}')))::INT AS entity_count,
              round(coalesce(list_sum(list_transform(words, lambda x: length(x))) / n / 10, 0), 9)::DOUBLE AS complexity_score FROM s""",
    "posts",
)
def text_features(t):
    features = t.posts.select("doc_id", text.text_features("text").alias("f")).select("doc_id", "f.*")
    return rounded(features, sentiment_score=9, complexity_score=9)


@query(
    "ud15_doubled",
    """SELECT ride_id, coalesce(try_cast(try_cast(CASE WHEN rideable_type <> 'classic_bike' THEN started_at WHEN member_casual = 'casual'
              THEN start_station_id || '00000000' ELSE start_station_id END AS INT)::BIGINT * 2 AS INT), 0) AS doubled FROM trips_raw""",
    "trips_raw",
)
def doubled(t):
    """Some of the numbers are too large, or too large once doubled."""
    station = F.col("start_station_id")
    large = F.when(F.col("member_casual") == "casual", F.concat(station, F.lit("00000000"))).otherwise(station)
    mixed = F.when(F.col("rideable_type") == "classic_bike", large).otherwise(F.col("started_at"))
    return t.trips_raw.withColumn("mixed", mixed).select("ride_id", validation.doubled("mixed").alias("doubled"))


VALUES = """
    SELECT customer_id, 'email' AS kind, email AS value FROM customers
    UNION ALL SELECT customer_id, 'phone', phone FROM customers
    UNION ALL SELECT transaction_id, 'currency', CASE transaction_id % 4 WHEN 0 THEN '$' || CAST(CAST(amount AS DECIMAL(12,2)) AS VARCHAR)
                WHEN 1 THEN '-$' || CAST(CAST(amount AS DECIMAL(12,2)) AS VARCHAR) WHEN 2 THEN CASE WHEN transaction_id % 3 = 0 THEN repeat('9', 40) ELSE 'free' END ELSE NULL END FROM transactions
    UNION ALL SELECT transaction_id, 'date', CASE transaction_id % 4 WHEN 0 THEN strftime(transaction_date, '%Y-%m-%d')
                WHEN 1 THEN strftime(transaction_date, '%m/%d/%Y') WHEN 2 THEN strftime(transaction_date, '%d-%m-%Y')
                ELSE 'some day' END FROM transactions
"""


@query(
    "ud16_validate",
    f"""WITH v AS ({VALUES}), p AS (SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS digits, lower(trim(value)) AS cleaned,
              try_cast(try_cast(regexp_replace(value, '[^0-9.-]', '', 'g') AS DOUBLE) AS DECIMAL(38,2)) AS number,
              CASE WHEN customer_id % 4 = 3 OR kind <> 'date' THEN NULL ELSE (SELECT max(transaction_date) FROM transactions t
                   WHERE t.transaction_id = v.customer_id) END AS d FROM v),
        q AS (SELECT *, CASE WHEN length(digits) = 10 THEN digits WHEN length(digits) = 11 AND digits[1] = '1' THEN digits[2:11] END AS local FROM p)
        SELECT customer_id AS id, kind,
          CASE kind WHEN 'email' THEN coalesce(regexp_matches(cleaned, '^[\\w\\.-]+@[\\w\\.-]+\\.\\w+$'), false)
               WHEN 'phone' THEN local IS NOT NULL WHEN 'currency' THEN number IS NOT NULL ELSE d IS NOT NULL END AS is_valid,
          CASE kind WHEN 'email' THEN CASE WHEN value IS NULL OR NOT contains(value, '@') THEN 'Invalid email format'
                      WHEN NOT regexp_matches(cleaned, '^[\\w\\.-]+@[\\w\\.-]+\\.\\w+$') THEN 'Invalid email pattern' ELSE '' END
               WHEN 'phone' THEN CASE WHEN value IS NULL THEN 'Missing phone number' WHEN local IS NULL THEN 'Invalid phone number length' ELSE '' END
               WHEN 'currency' THEN CASE WHEN value IS NULL THEN 'Missing currency value' WHEN number IS NULL THEN 'Invalid currency format'
                      WHEN number < 0 THEN 'Negative currency value' ELSE '' END
               ELSE CASE WHEN value IS NULL THEN 'Missing date' WHEN d IS NULL THEN 'Invalid date format' ELSE '' END END AS validation_errors,
          CASE kind WHEN 'email' THEN CASE WHEN contains(value, '@') THEN cleaned ELSE coalesce(value, '') END
               WHEN 'phone' THEN coalesce('(' || local[1:3] || ') ' || local[4:6] || '-' || local[7:10], value, '')
               WHEN 'currency' THEN coalesce('$' || CAST(number AS VARCHAR), value, '')
               ELSE coalesce(strftime(d, '%Y-%m-%d'), value, '') END AS cleansed_value
        FROM q""",
    "customers transactions",
)
def validate(t):
    money = F.col("amount").cast("decimal(12,2)").cast("string")
    turn = F.col("transaction_id") % 4
    odd = F.when(F.col("transaction_id") % 3 == 0, "9" * 40).otherwise("free")
    shown_money = F.when(turn == 0, F.concat(F.lit("$"), money)).when(turn == 1, F.concat(F.lit("-$"), money)).when(turn == 2, odd)
    shown_date = (
        F.when(turn == 0, F.date_format("transaction_date", "yyyy-MM-dd"))
        .when(turn == 1, F.date_format("transaction_date", "MM/dd/yyyy"))
        .when(turn == 2, F.date_format("transaction_date", "dd-MM-yyyy"))
        .otherwise("some day")
    )
    people, money_rows = t.customers, t.transactions
    values = people.select(F.col("customer_id").alias("id"), F.lit("email").alias("kind"), F.col("email").alias("value"))
    values = values.union(people.select("customer_id", F.lit("phone"), "phone"))
    values = values.union(money_rows.select("transaction_id", F.lit("currency"), shown_money))
    values = values.union(money_rows.select("transaction_id", F.lit("date"), shown_date))
    return values.select("id", "kind", validation.validated("value", "kind").alias("v")).select("id", "kind", "v.*")


@query(
    "ud17_rules",
    """SELECT customer_id, passed::INT AS passed, (4 - passed)::INT AS failed,
              concat_ws('|', CASE WHEN NOT a THEN 'min_age' END, CASE WHEN NOT m THEN 'max_transaction' END,
                        CASE WHEN NOT s THEN 'valid_state' END, CASE WHEN NOT p THEN 'positive_balance' END) AS failed_rules,
              CASE 4 - passed WHEN 0 THEN 'APPROVED' WHEN 1 THEN 'REVIEW' WHEN 2 THEN 'REVIEW' ELSE 'REJECTED' END AS status
       FROM (SELECT *, a::INT + m::INT + s::INT + p::INT AS passed FROM (
         SELECT customer_id, coalesce(age, 0) >= 18 AS a, amount <= 10000 AS m, customer_id % 3 = 0 AS s, customer_id % 10 <> 0 AS p
         FROM (SELECT customer_id, age, (customer_id * 37) % 20000 AS amount FROM customers)))""",
    "customers",
)
def rules(t):
    state = F.when(F.col("customer_id") % 3 == 0, "TX").otherwise("XX")
    balance = F.when(F.col("customer_id") % 10 == 0, "-5.5").otherwise("2000")
    record = F.concat_ws(
        "|", F.when(F.col("customer_id") % 6 == 0, "amount=999999|state=none"),  # repeated fields: the last counts
        F.concat(F.lit("age="), F.col("age").cast("string")),
        F.concat(F.lit("amount="), (F.col("customer_id") * 37 % 20000).cast("string")),
        F.concat(F.lit("state="), state), F.concat(F.lit("balance="), balance),
    )
    records = t.customers.select("customer_id", record.alias("record"))
    return validation.apply_rules(records, "record", validation.CUSTOMER_RULES).drop("record")


@query(
    "ud20_discount",
    """SELECT customer_id, round(spent * CASE WHEN spent >= 200 THEN 0.15 WHEN spent >= 100 THEN 0.10 ELSE 0.05 END, 5)
              AS total_discount FROM (SELECT customer_id, sum(amount) / 20000 AS spent FROM transactions GROUP BY 1)""",
    "transactions",
)
def discount(t):
    register_sql_functions(t.spark)
    discounts = t.spark.sql(
        """SELECT customer_id, calculate_discount(sum(amount) / 20000) AS total_discount
           FROM {transactions} GROUP BY customer_id""",
        transactions=t.transactions,
    )
    return rounded(discounts, total_discount=5)


@query(
    "ud20b_discount_column",
    """SELECT customer_id, round(spent * CASE WHEN spent >= 200 THEN 0.15 WHEN spent >= 100 THEN 0.10 ELSE 0.05 END, 5)
              AS total_discount FROM (SELECT customer_id, sum(amount) / 20000 AS spent FROM transactions GROUP BY 1)""",
    "transactions",
)
def discount_column(t):
    spent = t.transactions.groupBy("customer_id").agg((F.sum("amount") / 20000).alias("spent"))
    return spent.select("customer_id", r(scores.tiered_discount("spent"), 5).alias("total_discount"))


@query(
    "ud18_python_equals_builtin",
    "SELECT count(*) AS row_count, 0::BIGINT AS differing FROM transactions",
    "transactions",
)
def python_equals_builtin(t):
    """The same classes from a Python function and from columns."""

    def amount_class(amount):
        if amount is None:
            return "unknown"
        return "high" if amount > 1000 else "medium" if amount > 100 else "low"

    as_python = register_python(t.spark, "amount_class_py", amount_class, "string")
    scaled = t.transactions.select((F.col("amount") / 300).alias("amount"))
    both = scaled.select(as_python("amount").alias("p"), tiers.amount_class("amount").alias("b"))
    return both.agg(F.count("*").alias("row_count"), F.count_if(~F.col("p").eqNullSafe(F.col("b"))).alias("differing"))
