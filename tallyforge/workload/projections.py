"""Projections, filters, predicates, de-duplication."""

from pyspark.sql import functions as F

from tallyforge.functions import tiers
from tallyforge.operators import dedup, expectations
from tallyforge.plans import trips
from tallyforge.workload.registry import query, r, rounded, stamp


@query("prj01_select", "SELECT customer_id, name, state FROM customers", "customers")
def select_columns(t):
    return t.customers.select("customer_id", "name", "state")


@query(
    "prj02_typed_projection",
    """SELECT ride_id, strftime(try_cast(started_at AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS started_at,
              strftime(try_cast(ended_at AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ended_at,
              try_cast(start_lat AS DOUBLE) AS start_lat, try_cast(end_lng AS DOUBLE) AS end_lng FROM trips_raw""",
    "trips_raw",
)
def typed_projection(t):
    typed = trips.typed_trips(t.trips_raw)
    return typed.select("ride_id", stamp("started_at").alias("started_at"), stamp("ended_at").alias("ended_at"),
                        "start_lat", "end_lng")


@query(
    "prj03_discount_per_unit",
    """SELECT transaction_id, product, quantity,
              round(unit_price - paid_price / nullif(quantity, 0), 9) AS discount_per_unit FROM sales""",
    "sales",
)
def discount_per_unit(t):
    paid = F.try_divide("paid_price", "quantity")
    return t.sales.select("transaction_id", "product", "quantity", r(F.col("unit_price") - paid, 9).alias("discount_per_unit"))


@query(
    "prj04_derive_filter_sort",
    """SELECT transaction_id, product, round(quantity * unit_price, 2) AS revenue FROM sales
       WHERE quantity * unit_price > 50000 ORDER BY revenue DESC""",
    "sales",
)
def derive_filter_sort(t):
    return (
        t.sales.withColumn("revenue", F.col("quantity") * F.col("unit_price"))
        .filter("revenue > 50000")
        .select("transaction_id", "product", r("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


@query("prj05_rename", "SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer")
def rename(t):
    renamed = t.customer.withColumnsRenamed({"c_custkey": "customer_id", "c_mktsegment": "segment"})
    return renamed.select("customer_id", "segment")


@query("prj06_drop", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def drop(t):
    return t.part.drop("p_size", "p_retailprice")


@query(
    "prj07_tiers",
    """SELECT t.transaction_id,
              CASE WHEN amount < 50000 THEN 'Low' WHEN amount < 200000 THEN 'Medium' ELSE 'High' END AS amount_category,
              CASE WHEN age < 25 THEN '18-25' WHEN age < 35 THEN '26-35' WHEN age < 45 THEN '36-45'
                   WHEN age < 55 THEN '46-55' ELSE '55+' END AS age_group,
              CASE WHEN age < 25 THEN 'Young' WHEN age < 35 THEN 'Adult' ELSE 'Senior' END AS age_category
       FROM transactions t JOIN customers c USING (customer_id)""",
    "transactions customers",
)
def tier_columns(t):
    joined = t.transactions.join(t.customers.select("customer_id", "age"), "customer_id")
    return joined.select(
        "transaction_id",
        tiers.below("amount", ((50_000, "Low"), (200_000, "Medium")), "High").alias("amount_category"),
        tiers.age_group("age").alias("age_group"),
        tiers.age_category("age").alias("age_category"),
    )


@query("prj08_constant", "SELECT c_custkey, 'Social Platform' AS platform, 0 AS posts_count FROM customer")
def constants(t):
    return t.customer.select("c_custkey", F.lit("Social Platform").alias("platform"), F.lit(0).alias("posts_count"))


@query(
    "prj09_left_star_and_some_right",
    """SELECT t.transaction_id, t.customer_id, t.amount, t.category, t.payment_method, t.is_weekend, c.name, c.state
       FROM transactions t JOIN customers c ON t.customer_id = c.customer_id""",
    "transactions customers",
)
def left_star(t):
    joined = t.transactions.alias("l").join(
        t.customers.alias("r"), F.col("l.customer_id") == F.col("r.customer_id")
    )
    return joined.select("l.*", F.col("r.name"), F.col("r.state")).drop("transaction_date")


@query(
    "prj10_struct_fields",
    """SELECT transaction_id, hour(sold_at)::INT AS hour, (isodow(sold_at) - 1)::INT AS weekday,
              strftime(date_trunc('hour', sold_at), '%Y-%m-%d %H:%M:%S') AS window_start FROM sales""",
    "sales",
)
def struct_fields(t):
    packed = t.sales.select(
        "transaction_id",
        F.struct(F.hour("sold_at").alias("hour"), F.weekday("sold_at").alias("weekday")).alias("time"),
        F.window(F.col("sold_at").cast("timestamp"), "1 hour").alias("window"),
    )
    return packed.select("transaction_id", "time.hour", "time.weekday", stamp("window.start").alias("window_start"))


@query(
    "prj11_filters",
    "SELECT * EXCLUDE (ts) FROM events WHERE event_type <> 'error' AND user_id <> 8 AND value > 10 AND value IS NOT NULL",
)
def stacked_filters(t):
    stacked = t.events.filter(F.col("event_type") != "error").filter(F.col("user_id") != 8)
    return stacked.filter("value > 10").filter("value > 5").filter("value > 10").drop("ts")


@query(
    "prj12_string_predicates",
    """SELECT p_partkey, p_name FROM part
       WHERE (starts_with(p_name, 'red') OR contains(p_name, 'ring') OR regexp_matches(p_name, '^b.*t$'))
         AND p_type IN ('ECONOMY', 'SMALL')""",
)
def string_predicates(t):
    name = F.col("p_name")
    chosen = name.startswith("red") | name.contains("ring") | name.rlike("^b.*t$")
    return t.part.filter(chosen & F.col("p_type").isin("ECONOMY", "SMALL")).select("p_partkey", "p_name")


@query(
    "prj13_null_predicates",
    """SELECT customer_id, email IS NULL AS no_email, (email IS NULL OR email = '') AS missing_email
       FROM customers WHERE age IS NOT NULL""",
    "customers",
)
def null_predicates(t):
    email = F.col("email")
    return t.customers.filter(F.col("age").isNotNull()).select(
        "customer_id", email.isNull().alias("no_email"), (email.isNull() | (email == "")).alias("missing_email")
    )


@query("prj14_between", "SELECT customer_id, age FROM customers WHERE age BETWEEN 25 AND 45", "customers")
def between(t):
    return t.customers.filter(F.col("age").between(25, 45)).select("customer_id", "age")


TYPED_TRIPS_SQL = """
    SELECT *, (epoch(ended) - epoch(started))::BIGINT AS duration_seconds FROM (
      SELECT *, try_cast(started_at AS TIMESTAMP) AS started, try_cast(ended_at AS TIMESTAMP) AS ended FROM trips_raw)
"""


@query(
    "prj15_expectations",
    f"""SELECT rule, failures FROM (
          SELECT count(*) FILTER (WHERE started IS NULL) AS non_null_started_at,
                 count(*) FILTER (WHERE ended IS NULL) AS non_null_ended_at,
                 count(*) FILTER (WHERE NOT coalesce(start_lat::DOUBLE BETWEEN -90 AND 90, false)) AS valid_start_lat,
                 count(*) FILTER (WHERE NOT coalesce(start_lng::DOUBLE BETWEEN -180 AND 180, false)) AS valid_start_lng,
                 count(*) FILTER (WHERE NOT coalesce(end_lat::DOUBLE BETWEEN -90 AND 90, false)) AS valid_end_lat,
                 count(*) FILTER (WHERE NOT coalesce(end_lng::DOUBLE BETWEEN -180 AND 180, false)) AS valid_end_lng,
                 count(*) FILTER (WHERE NOT coalesce(duration_seconds > 0, false)) AS positive_duration,
                 count(*) FILTER (WHERE NOT coalesce(duration_seconds < 86400, false)) AS reasonable_duration,
                 count(*) FILTER (WHERE start_station_name IS NULL) AS non_null_start_station,
                 count(*) FILTER (WHERE end_station_name IS NULL) AS non_null_end_station
          FROM ({TYPED_TRIPS_SQL})) UNPIVOT (failures FOR rule IN (COLUMNS(*)))""",
    "trips_raw",
)
def expectation_counts(t):
    return expectations.count_failures(trips.typed_trips(t.trips_raw), trips.EXPECTATIONS)


@query("prj16_distinct", "SELECT DISTINCT n_name AS state FROM nation JOIN customer ON n_nationkey = c_nationkey ORDER BY 1")
def distinct_values(t):
    return t.customers.select("state").distinct().orderBy("state")


@query(
    "prj17_dedup",
    """SELECT pickup_zip, dropoff_zip, fare_amount, trip_distance FROM (
         SELECT *, row_number() OVER (PARTITION BY pickup_at, pickup_zip, dropoff_zip
                                      ORDER BY fare_amount, dropoff_at, trip_distance) AS rn FROM taxi) WHERE rn = 1""",
    "taxi",
)
def exact_dedup(t):
    order = [F.col(c) for c in ("fare_amount", "dropoff_at", "trip_distance")]
    unique = dedup.keep_first(t.taxi, ["pickup_at", "pickup_zip", "dropoff_zip"], *order)
    return unique.select("pickup_zip", "dropoff_zip", "fare_amount", "trip_distance")


def noisy_customers(t):
    """350 spellings of every customer."""
    people = t.customers.select(
        "customer_id", F.col("name").alias("first_name"),
        F.concat(F.lit("Smith"), (F.col("customer_id") % 100).cast("string")).alias("last_name"),
        F.col("email").alias("email_address"), F.col("phone").alias("phone_number"),
        F.concat(F.lit("AB-"), (F.col("customer_id") % 500).cast("string")).alias("postal_zip_code"), "gender",
    )
    cores = t.spark.sparkContext.defaultParallelism
    return dedup.with_noisy_copies(people, 350, {"first_name": 3, "last_name": 2, "email_address": 4}, cores)


NOISY_SQL = """
    SELECT customer_id, CASE WHEN d % 3 = 0 THEN upper(name) ELSE name END AS first_name,
           CASE WHEN d % 2 = 0 THEN upper('Smith' || CAST(customer_id % 100 AS VARCHAR)) ELSE 'Smith' || CAST(customer_id % 100 AS VARCHAR) END AS last_name,
           CASE WHEN d % 4 = 0 THEN upper(email) ELSE email END AS email_address, phone AS phone_number,
           'AB-' || CAST(customer_id % 500 AS VARCHAR) AS postal_zip_code, gender, d AS duplicate_id
    FROM customers, range(350) AS copies(d)
"""


@query(
    "prj18_dedup_ignoring_case",
    f"""SELECT first_name, last_name, email_address, duplicate_id::INT AS duplicate_id FROM (
          SELECT *, row_number() OVER (PARTITION BY lower(first_name), lower(last_name), lower(email_address)
                                       ORDER BY duplicate_id DESC, customer_id) AS rn
          FROM ({NOISY_SQL})) WHERE rn = 1""",
    "customers",
)
def dedup_ignoring_case(t):
    kept = dedup.keep_first_ignoring_case(
        noisy_customers(t), ["first_name", "last_name", "email_address"], [F.desc("duplicate_id"), F.col("customer_id")]
    )
    return kept.select("first_name", "last_name", "email_address", "duplicate_id")


@query(
    "prj19_dedup_standardised",
    f"""SELECT first_name, phone_number, postal_zip_code, gender FROM (
          SELECT *, row_number() OVER (PARTITION BY lower(first_name), lower(last_name), lower(email_address),
                      regexp_replace(phone_number, '[^0-9]', '', 'g'), regexp_replace(postal_zip_code, '[^0-9]', '', 'g'), gender
                      ORDER BY duplicate_id, customer_id) AS rn
          FROM ({NOISY_SQL})) WHERE rn = 1""",
    "customers",
)
def dedup_standardised(t):
    kept = dedup.keep_first_standardised(
        noisy_customers(t), ["first_name", "last_name", "email_address"], ["phone_number", "postal_zip_code"],
        [F.col("duplicate_id"), F.col("customer_id")], ["gender"],
    )
    return kept.select("first_name", "phone_number", "postal_zip_code", "gender")


@query("prj20_sample", "SELECT count(*) AS row_count, true AS size_as_expected, 0::BIGINT AS foreign_rows FROM lineitem")
def bernoulli_sample(t):
    """A tenth of the rows within five deviations, all of them rows of the table."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    sample = lines.sample(withReplacement=False, fraction=0.1, seed=42)
    sampled = sample.agg(F.count("*").alias("n")).scalar()
    foreign = sample.join(lines, lines.columns, "left_anti").agg(F.count("*").alias("n")).scalar()
    rows = F.col("row_count")
    return lines.agg(F.count("*").alias("row_count")).select(
        "row_count", (F.abs(sampled - 0.1 * rows) <= 5 * F.sqrt(rows * 0.09)).alias("size_as_expected"), foreign.alias("foreign_rows")
    )


@query(
    "prj21_noisy_copies",
    f"""SELECT duplicate_id::INT AS duplicate_id, count(*) AS copies, count(DISTINCT first_name) AS names,
               count(*) FILTER (WHERE last_name = upper(last_name)) AS upper_names,
               count(*) FILTER (WHERE email_address = upper(email_address)) AS upper_emails
        FROM ({NOISY_SQL}) GROUP BY 1""",
    "customers",
)
def noisy_copies(t):
    return noisy_customers(t).groupBy("duplicate_id").agg(
        F.count("*").alias("copies"),
        F.count_distinct("first_name").alias("names"),
        F.count_if(F.col("last_name") == F.upper("last_name")).alias("upper_names"),
        F.count_if(F.col("email_address") == F.upper("email_address")).alias("upper_emails"),
    )


@query(
    "prj22_shares",
    """SELECT traffic_source, count(*) AS rows_tagged FROM (
         SELECT CASE WHEN event_id % 100 < 40 THEN 'walk-in' WHEN event_id % 100 < 65 THEN 'online-order'
                     WHEN event_id % 100 < 85 THEN 'delivery-app' WHEN event_id % 100 < 95 THEN 'phone-order'
                     ELSE 'social-media' END AS traffic_source FROM events) GROUP BY 1""",
)
def tag_by_shares(t):
    tagged = t.events.select(tiers.shares(F.col("event_id"), tiers.TRAFFIC_SOURCES).alias("traffic_source"))
    return tagged.groupBy("traffic_source").agg(F.count("*").alias("rows_tagged"))


@query(
    "prj23_keys_and_values",
    """SELECT 'distinct keys' AS part, count(DISTINCT customer_id) AS entries, 0.0::DOUBLE AS total FROM transactions
       UNION ALL SELECT 'values', count(amount), round(sum(amount), 2) FROM transactions""",
    "transactions",
)
def keys_and_values(t):
    keyed = t.transactions.select("customer_id", "amount")
    keys = keyed.select("customer_id").distinct().agg(
        F.lit("distinct keys").alias("part"), F.count("*").alias("entries"), F.lit(0.0).alias("total")
    )
    values = keyed.select("amount").agg(
        F.lit("values").alias("part"), F.count("amount").alias("entries"), r(F.sum("amount")).alias("total")
    )
    return keys.unionByName(values)


@query("prj24_filter_by_text", "SELECT pickup_zip, fare_amount FROM taxi WHERE fare_amount <= 0", "taxi")
def filter_by_text(t):
    return t.taxi.filter("fare_amount <= 0").select("pickup_zip", "fare_amount")
