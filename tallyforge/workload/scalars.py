"""Scalar functions."""

from pyspark.sql import functions as F, types as T

from tallyforge.functions import text, times
from tallyforge.operators.layout import bucket_of
from tallyforge.operators.totals import with_totals
from tallyforge.workload.registry import day, query, r, stamp


@query(
    "sc01_case_and_space",
    """SELECT customer_id, lower(trim(email)) AS email, upper(state) AS state, trim(email) AS trimmed,
              upper(left(lower(state), 1)) || substring(lower(state), 2) AS title FROM customers""",
    "customers",
)
def case_and_space(t):
    return t.customers.select(
        "customer_id", F.lower(F.trim("email")).alias("email"), F.upper("state").alias("state"),
        F.trim("email").alias("trimmed"), F.initcap("state").alias("title"),
    )


@query(
    "sc02_regex_replace",
    """SELECT customer_id, regexp_replace(phone, '[^0-9]', '', 'g') AS digits,
              regexp_replace(email, '@\\S+', '', 'g') AS local_part FROM customers""",
    "customers",
)
def regex_replace(t):
    return t.customers.select(
        "customer_id", F.regexp_replace("phone", "[^0-9]", "").alias("digits"),
        text.without_mentions("email").alias("local_part"),
    )


@query(
    "sc03_all_matches",
    """SELECT doc_id, array_to_string(regexp_extract_all(text, '@[\\p{L}\\p{N}_]+'), ' ') AS mentions,
              len(regexp_extract_all(text, '@[\\p{L}\\p{N}_]+'))::INT AS hits FROM posts""",
    "posts",
)
def all_matches(t):
    found = t.posts.select("doc_id", text.mentions("text").alias("found"))
    return found.select("doc_id", F.array_join("found", " ").alias("mentions"), F.size("found").alias("hits"))


@query(
    "sc04_split_and_length",
    """SELECT doc_id, len(string_split(text, ' '))::INT AS parts, len(regexp_split_to_array(text, '\\s+'))::INT AS words,
              length(text)::INT AS letters FROM documents""",
)
def split_and_length(t):
    return t.documents.select(
        "doc_id", F.size(F.split("text", " ")).alias("parts"), F.size(F.split("text", r"\s+")).alias("words"),
        F.length("text").alias("letters"),
    )


@query(
    "sc05_date_parts",
    """SELECT event_id, year(ts)::INT AS year, quarter(ts)::INT AS quarter, month(ts)::INT AS month, day(ts)::INT AS day,
              hour(ts)::INT AS hour, (dayofweek(ts) + 1)::INT AS day_of_week FROM events""",
)
def date_parts(t):
    return t.events.select(
        "event_id", F.year("ts").alias("year"), F.quarter("ts").alias("quarter"), F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"), F.dayofweek("ts").alias("day_of_week"),
    )


@query(
    "sc06_date_format",
    """SELECT event_id, strftime(ts, '%Y-%m') AS year_month, strftime(ts, '%a') AS short_day,
              strftime(ts, '%A') AS long_day FROM events""",
)
def date_format(t):
    return t.events.select(
        "event_id", F.date_format("ts", "yyyy-MM").alias("year_month"), F.date_format("ts", "EEE").alias("short_day"),
        F.date_format("ts", "EEEE").alias("long_day"),
    )


@query(
    "sc07_parse_times",
    """SELECT doc_id, CASE WHEN doc_id % 41 = 0 THEN NULL ELSE
              strftime(TIMESTAMP '2009-04-06 22:19:45' + to_minutes(doc_id::INT), '%Y-%m-%d %H:%M:%S') END AS posted_at
       FROM posts""",
    "posts",
)
def parse_times(t):
    return t.posts.select("doc_id", stamp(times.parse_feed_time("date")).alias("posted_at"))


@query(
    "sc08_truncate",
    """SELECT event_id, strftime(ts::DATE, '%Y-%m-%d') AS day, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start,
              strftime(date_trunc('month', ts), '%Y-%m-%d') AS month_start FROM events""",
)
def truncate(t):
    return t.events.select(
        "event_id", day(F.to_date("ts")).alias("day"), day(times.week_start("ts")).alias("week_start"),
        day(F.date_trunc("MONTH", "ts").cast("date")).alias("month_start"),
    )


@query(
    "sc09_time_between",
    """SELECT pickup_zip, dropoff_zip, (epoch(dropoff_at) - epoch(pickup_at))::BIGINT AS seconds,
              round((epoch(dropoff_at) - epoch(pickup_at)) / 60.0, 2)::DOUBLE AS minutes FROM taxi""",
    "taxi",
)
def time_between(t):
    seconds = times.seconds_between("pickup_at", "dropoff_at")
    return t.taxi.select("pickup_zip", "dropoff_zip", seconds.alias("seconds"), r(seconds / F.lit(60.0)).alias("minutes"))


@query(
    "sc10_date_arithmetic",
    """SELECT o_orderkey, date_diff('day', DATE '1995-01-01', o_orderdate::DATE)::INT AS days,
              strftime(o_orderdate::DATE + INTERVAL 1 MONTH, '%Y-%m-%d') AS next_month,
              date_diff('month', DATE '1995-01-01', date_trunc('month', o_orderdate)::DATE)::DOUBLE AS months,
              strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS next_day FROM orders""",
)
def date_arithmetic(t):
    start = F.lit("1995-01-01").cast("date")
    return t.orders.select(
        "o_orderkey", F.datediff("o_orderdate", start).alias("days"),
        day(F.add_months("o_orderdate", 1)).alias("next_month"),
        F.months_between(F.trunc("o_orderdate", "MM"), start).alias("months"),
        stamp(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("next_day"),
    )


@query(
    "sc11_age_in_days",
    "SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '2002-01-01')::INT AS days_since FROM orders",
)
def age_in_days(t):
    return t.orders.select("o_orderkey", F.datediff(F.lit("2002-01-01").cast("date"), "o_orderdate").alias("days_since"))


@query(
    "sc12_math",
    """SELECT c_custkey, c_custkey % 7 AS remainder, round(power(c_acctbal, 2), 3) AS square, abs(c_acctbal) AS size,
              round(c_acctbal / 3 - 1.5, 6) AS shifted FROM customer""",
)
def math(t):
    balance = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", (F.col("c_custkey") % 7).alias("remainder"), r(F.pow(balance, 2), 3).alias("square"),
        F.abs(balance).alias("size"), r(balance / 3 - F.lit(1.5), 6).alias("shifted"),
    )


@query(
    "sc13_safe_division",
    """SELECT user_id, coalesce(round(following_count / nullif(follower_count, 0), 9), -1) AS ratio FROM social""",
    "social",
)
def safe_division(t):
    ratio = F.try_divide("following_count", "follower_count")
    return t.social.select("user_id", F.coalesce(r(ratio, 9), F.lit(-1.0)).alias("ratio"))


@query(
    "sc14_missing",
    """SELECT franchise_id, coalesce(size, 'Unknown') AS size FROM franchises
       UNION ALL SELECT customer_id, coalesce(gender, 'none') FROM customers WHERE age IS NOT NULL""",
    "franchises customers",
)
def missing(t):
    franchises = t.franchises.select("franchise_id", "size").na.fill({"size": "Unknown"})
    people = t.customers.select("customer_id", "gender", "age").dropna(subset=["age"])
    return franchises.union(people.select("customer_id", F.coalesce("gender", F.lit("none"))))


@query(
    "sc15_arrays",
    """WITH m AS (SELECT doc_id, regexp_extract_all(text, '@[\\p{L}\\p{N}_]+') AS found FROM posts)
       SELECT doc_id, len(found)::INT AS hits, lower(unnest(CASE WHEN len(found) = 0 THEN [NULL] ELSE found END)) AS mention FROM m""",
    "posts",
)
def arrays(t):
    found = t.posts.select("doc_id", text.mentions("text").alias("found"))
    exploded = found.select("doc_id", F.size("found").alias("hits"), F.explode_outer("found").alias("mention"))
    return exploded.withColumn("mention", F.lower("mention"))


@query("sc16_map_lookup", "SELECT event_id, strftime(ts, '%a') AS day_label FROM events")
def map_lookup(t):
    return t.events.select("event_id", times.day_label("ts").alias("day_label"))


@query(
    "sc17_decimals",
    """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2))::VARCHAR AS price,
              CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(1.10 AS DECIMAL(3,2)) AS DECIMAL(12,2))::VARCHAR AS raised FROM orders""",
)
def decimals(t):
    price = F.col("o_totalprice").cast("decimal(12,2)")
    raised = (price * F.lit("1.10").cast("decimal(3,2)")).cast("decimal(12,2)")
    return t.orders.select("o_orderkey", price.cast("string").alias("price"), raised.cast("string").alias("raised"))


@query("sc18_hash_buckets", "SELECT range::INT AS bucket, (SELECT count(*) FROM events) AS all_rows, true AS fair_share FROM range(10)")
def hash_buckets(t):
    """All buckets occur, no row is lost, and none has more than twice its share."""
    sizes = bucket_of(t.events, 10, "event_id").groupBy("bucket").agg(F.count("*").alias("row_count"))
    total = t.events.agg(F.count("*").alias("all_rows"))
    return with_totals(sizes, total).select("bucket", "all_rows", (F.col("row_count") * 5 <= F.col("all_rows")).alias("fair_share"))


@query(
    "sc19_boolean_text",
    """SELECT transaction_id, coalesce(CASE is_weekend WHEN 'true' THEN 'yes' WHEN 'false' THEN 'no' END, 'unknown') AS weekend
       FROM transactions""",
    "transactions",
)
def boolean_text(t):
    flag = F.when(F.col("is_weekend").isin("true", "false"), F.col("is_weekend").try_cast("boolean"))
    label = F.when(flag, "yes").when(~flag, "no").otherwise("unknown")
    return t.transactions.select("transaction_id", label.alias("weekend"))


@query(
    "sc20_case_on_aggregates",
    """SELECT user_id, CASE WHEN avg(value) > 60 THEN 'High' WHEN avg(value) > 40 THEN 'Medium' ELSE 'Low' END AS level
       FROM events GROUP BY 1""",
)
def case_on_aggregates(t):
    return t.spark.sql(
        """SELECT user_id, CASE WHEN avg(value) > 60 THEN 'High' WHEN avg(value) > 40 THEN 'Medium' ELSE 'Low' END AS level
           FROM {events} GROUP BY user_id""",
        events=t.events,
    )


@query(
    "sc21_one_to_many",
    """SELECT 'arrays' AS shape, count(*) AS row_count FROM conversations
       UNION ALL SELECT 'rows', sum(len(string_split(text, ' ')))::BIGINT FROM conversations""",
)
def one_to_many(t):
    arrays = t.conversations.select(F.split("text", " ").alias("words"))
    rows = arrays.select(F.explode("words").alias("word"))
    return arrays.agg(F.lit("arrays").alias("shape"), F.count("*").alias("row_count")).unionByName(
        rows.agg(F.lit("rows").alias("shape"), F.count("*").alias("row_count"))
    )


@query(
    "sc22_cast_in_aggregate",
    """SELECT rideable_type, round(avg(try_cast(start_lat AS DOUBLE)), 6) AS mean_lat,
              count(try_cast(started_at AS TIMESTAMP)) AS readable_times FROM trips_raw GROUP BY 1""",
    "trips_raw",
)
def cast_in_aggregate(t):
    return t.spark.sql(
        """SELECT rideable_type, round(avg(try_cast(start_lat AS DOUBLE)), 6) AS mean_lat,
                  count(try_cast(started_at AS TIMESTAMP)) AS readable_times FROM {trips} GROUP BY rideable_type""",
        trips=t.trips_raw,
    )
