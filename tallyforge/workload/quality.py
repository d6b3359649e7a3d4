"""Data-quality jobs."""

from pyspark.sql import functions as F, types as T

from tallyforge.operators import evaluation, quality
from tallyforge.plans import taxi
from tallyforge.workload.registry import query, r, rounded

CUSTOMER_COLUMNS = ("customer_id", "name", "email", "age", "gender", "phone", "state")


def profiled(t):
    return t.customers.select(*CUSTOMER_COLUMNS)


@query(
    "dq01_missing",
    """SELECT "column", missing, round(missing * 100.0 / total, 6)::DOUBLE AS missing_pct FROM (
         SELECT count(*) AS total, count(*) FILTER (WHERE customer_id IS NULL) AS customer_id,
                count(*) FILTER (WHERE name IS NULL OR name = '') AS name,
                count(*) FILTER (WHERE email IS NULL OR email = '') AS email, count(*) FILTER (WHERE age IS NULL) AS age,
                count(*) FILTER (WHERE gender IS NULL OR gender = '') AS gender,
                count(*) FILTER (WHERE phone IS NULL OR phone = '') AS phone,
                count(*) FILTER (WHERE state IS NULL OR state = '') AS state FROM customers)
       UNPIVOT (missing FOR "column" IN (customer_id, name, email, age, gender, phone, state))""",
    "customers",
)
def missing(t):
    return rounded(quality.missing_values(profiled(t)), missing_pct=6)


@query(
    "dq02_schema_check",
    """SELECT "column", uncastable FROM (
         SELECT count(*) FILTER (WHERE started_at IS NOT NULL AND try_cast(started_at AS TIMESTAMP) IS NULL) AS started_at,
                count(*) FILTER (WHERE start_lat IS NOT NULL AND try_cast(start_lat AS DOUBLE) IS NULL) AS start_lat,
                count(*) FILTER (WHERE ride_id IS NOT NULL AND try_cast(ride_id AS INT) IS NULL) AS ride_id FROM trips_raw)
       UNPIVOT (uncastable FOR "column" IN (started_at, start_lat, ride_id))
       UNION ALL SELECT 'differences', 4""",
    "trips_raw",
)
def schema_check(t):
    """Values that do not fit the expected types, and how many columns differ from the expected schema."""
    expected = T.StructType(
        [T.StructField("started_at", T.TimestampType()), T.StructField("start_lat", T.DoubleType()),
         T.StructField("ride_id", T.IntegerType()), T.StructField("payment", T.StringType())]
    )
    raw = t.trips_raw.select("started_at", "start_lat", "ride_id")
    differences = F.lit(len(quality.schema_differences(raw, expected))).cast("long")
    uncastable = quality.uncastable_values(raw, expected)
    # The row of differences reads no data, so it stands beside the one aggregate over the table.
    return uncastable.union(t.spark.range(1).select(F.lit("differences"), differences))


@query(
    "dq03_outliers_iqr",
    """SELECT customer_id, balance, (balance < q1 - 1.5 * (q3 - q1) OR balance > q3 + 1.5 * (q3 - q1)) AS is_outlier
       FROM (SELECT customer_id, CASE WHEN customer_id % 50 = 0 THEN balance * 9 ELSE balance END AS balance
             FROM customers) c, (SELECT quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3
             FROM (SELECT CASE WHEN customer_id % 50 = 0 THEN balance * 9 ELSE balance END AS b FROM customers))""",
    "customers",
)
def outliers_iqr(t):
    spiked = F.when(F.col("customer_id") % 50 == 0, F.col("balance") * 9).otherwise(F.col("balance"))
    return evaluation.flag_outliers_iqr(t.customers.select("customer_id", spiked.alias("balance")), "balance")


@query(
    "dq04_outliers_zscore",
    """SELECT customer_id, round(abs(b - m) / s, 6) AS z_score, abs(b - m) / s > 3 AS is_outlier
       FROM (SELECT customer_id, CASE WHEN customer_id % 50 = 0 THEN balance * 9 ELSE balance END AS b FROM customers),
            (SELECT avg(b) AS m, stddev_samp(b) AS s
             FROM (SELECT CASE WHEN customer_id % 50 = 0 THEN balance * 9 ELSE balance END AS b FROM customers))""",
    "customers",
)
def outliers_zscore(t):
    spiked = F.when(F.col("customer_id") % 50 == 0, F.col("balance") * 9).otherwise(F.col("balance"))
    flagged = evaluation.flag_outliers_zscore(t.customers.select("customer_id", spiked.alias("balance")), "balance")
    return flagged.select("customer_id", r("z_score", 6).alias("z_score"), "is_outlier")


@query(
    "dq05_standardise",
    """SELECT customer_id, lower(trim(email)) AS email_clean,
              upper(left(trim(name), 1)) || lower(substring(trim(name), 2)) AS name_standardized,
              regexp_replace(phone, '[^0-9]', '', 'g') AS phone_clean, upper(trim(state)) AS state_code FROM customers""",
    "customers",
)
def standardise(t):
    return quality.standardise(t.customers).select(
        "customer_id", "email_clean", "name_standardized", "phone_clean", "state_code"
    )


@query(
    "dq06_fill_missing",
    """SELECT customer_id, coalesce(age, (SELECT quantile_disc(age, 0.5) FROM customers)) AS age,
              coalesce(gender, 'Unknown') AS gender, state, email FROM customers""",
    "customers",
)
def fill_missing(t):
    return quality.fill_missing(t.customers.select("customer_id", "age", "gender", "state", "email"))


@query(
    "dq07_rule_violations",
    """SELECT rule, violations FROM (
         SELECT count(*) FILTER (WHERE amount < 0) AS "Negative amounts", count(*) FILTER (WHERE age < 18 OR age > 120) AS "Invalid ages",
                count(*) FILTER (WHERE transaction_date > DATE '1998-06-01') AS "Future dates",
                count(*) FILTER (WHERE NOT regexp_matches(email, '^[\\w\\.-]+@[\\w\\.-]+\\.\\w+$')) AS "Invalid emails"
         FROM transactions JOIN customers USING (customer_id)) UNPIVOT (violations FOR rule IN (COLUMNS(*)))""",
    "transactions customers",
)
def rule_violations(t):
    joined = t.transactions.join(t.customers.select("customer_id", "age", "email"), "customer_id")
    return quality.rule_violations(joined, F.lit("1998-06-01").cast("date"))


@query(
    "dq08_report",
    """SELECT 'customers' AS dataset, count(*) AS total_rows, 7 AS total_columns, sum(gaps)::BIGINT AS missing_values,
              (count(*) - count(DISTINCT state))::BIGINT AS duplicates, round((1 - sum(gaps) / (count(*) * 7)) * 100, 6) AS completeness_pct
       FROM (SELECT state, (email IS NULL OR email = '')::INT + (age IS NULL)::INT + (gender IS NULL)::INT
                    + (phone IS NULL)::INT AS gaps FROM customers)""",
    "customers",
)
def report(t):
    return rounded(quality.quality_report(profiled(t), "customers", ["state"]), completeness_pct=6)


@query(
    "dq08b_report_all_columns",
    """SELECT 'customers' AS dataset, count(*) AS total_rows, 7 AS total_columns, sum(gaps)::BIGINT AS missing_values,
              (SELECT sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM rows GROUP BY customer_id, email, age, gender, phone, state, name)) AS duplicates,
              round((1 - sum(gaps) / (count(*) * 7)) * 100, 6) AS completeness_pct
       FROM (SELECT (email IS NULL OR email = '')::INT + (age IS NULL)::INT + (gender IS NULL)::INT + (phone IS NULL)::INT AS gaps FROM rows)""".replace(
        "FROM rows", "FROM (SELECT * FROM customers UNION ALL SELECT * FROM customers WHERE customer_id % 3 = 0)"),
    "customers",
)
def report_all_columns(t):
    """Every third customer is listed twice; rows equal in all columns count as duplicates."""
    people = profiled(t)
    return rounded(quality.quality_report(people.unionByName(people.where("customer_id % 3 = 0")), "customers"), completeness_pct=6)


@query(
    "dq09_issue_counts",
    """SELECT 'Invalid Fares' AS issue, count(*) AS count FROM taxi WHERE fare_amount <= 0
       UNION ALL SELECT 'Invalid Distance', count(*) FROM taxi WHERE trip_distance < 0
       UNION ALL SELECT 'Invalid Duration', count(*) FROM taxi WHERE dropoff_at <= pickup_at""",
    "taxi",
)
def issue_counts(t):
    return quality.label_counts(taxi.with_durations(t.taxi), taxi.invalid_trip(), "issue", "count")
