"""Tables the reports expect, derived from the test tables.

Each is one SELECT over the test tables. The text is shared by Spark and by the
SQL that checks it; only the few functions that differ are filled in per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.operators.layout import spread_out
from tallyforge.session import tune

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class _Spark:
    text = "STRING"

    @staticmethod
    def days(date: str, n: str) -> str:
        return f"date_add({date}, CAST({n} AS INT))"

    @staticmethod
    def hours(ts: str, n: str) -> str:
        return f"({ts} + make_dt_interval(0, CAST({n} AS INT)))"

    @staticmethod
    def minutes(ts: str, n: str) -> str:
        return f"({ts} + make_dt_interval(0, 0, CAST({n} AS INT)))"

    @staticmethod
    def stamp(ts: str) -> str:
        return f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss')"

    @staticmethod
    def feed_time(ts: str) -> str:
        return f"date_format({ts}, \"EEE MMM dd HH:mm:ss 'UTC' yyyy\")"

    @staticmethod
    def instant(literal: str) -> str:
        return f"TIMESTAMP_NTZ '{literal}'"


class _Sql:
    text = "VARCHAR"

    @staticmethod
    def days(date: str, n: str) -> str:
        return f"CAST({date} + CAST({n} AS INTEGER) AS DATE)"

    @staticmethod
    def hours(ts: str, n: str) -> str:
        return f"({ts} + to_hours(CAST({n} AS INTEGER)))"

    @staticmethod
    def minutes(ts: str, n: str) -> str:
        return f"({ts} + to_minutes(CAST({n} AS INTEGER)))"

    @staticmethod
    def stamp(ts: str) -> str:
        return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"

    @staticmethod
    def feed_time(ts: str) -> str:
        return f"strftime({ts}, '%a %b %d %H:%M:%S UTC %Y')"

    @staticmethod
    def instant(literal: str) -> str:
        return f"TIMESTAMP '{literal}'"


def _texts(d) -> dict[str, str]:
    trip_start = d.minutes(d.hours("o_orderdate", "l_partkey % 24"), "l_orderkey % 60")
    return {
        "transactions": """
            SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, o_totalprice AS amount,
                   o_orderpriority AS category, o_orderstatus AS payment_method, o_orderdate AS transaction_date,
                   CASE o_orderkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'n/a' END AS is_weekend
            FROM orders""",
        "customers": f"""
            SELECT c_custkey AS customer_id, c_name AS name,
                   CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'broken-address'
                        WHEN c_custkey % 17 = 0 THEN '' ELSE
                     ' User' || CAST(c_custkey AS {d.text}) || '@' || CASE c_custkey % 6 WHEN 0 THEN 'Gmail.com'
                       WHEN 1 THEN 'mycorp.net' WHEN 2 THEN 'state-university.edu' WHEN 3 THEN 'agency.gov'
                       WHEN 4 THEN 'example.org' ELSE 'company.com' END END AS email,
                   CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(16 + c_custkey % 70 AS INT) END AS age,
                   CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'X' ELSE NULL END AS gender,
                   n_name AS state, {d.days("DATE '1995-01-01'", "c_custkey % 365")} AS signup_date,
                   CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '1-555-' || CAST(1000000 + c_custkey AS {d.text})
                        WHEN 2 THEN '(555) ' || CAST(1000000 + c_custkey AS {d.text})
                        ELSE CAST(c_custkey AS {d.text}) END AS phone,
                   c_acctbal AS balance
            FROM customer JOIN nation ON c_nationkey = n_nationkey""",
        "products": """
            SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_retailprice AS price,
                   p_size AS stock_quantity
            FROM part""",
        "franchises": """
            SELECT s_suppkey AS franchise_id, s_name AS name, n_name AS city, r_name AS country,
                   CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'S' WHEN 2 THEN 'M' ELSE 'L' END AS size
            FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
        "sales": f"""
            SELECT l_orderkey AS transaction_id, o_custkey AS customer_id, l_suppkey AS franchise_id,
                   {d.hours("l_shipdate", "l_partkey % 24")} AS sold_at, l_partkey AS product, l_quantity AS quantity,
                   l_extendedprice / l_quantity AS unit_price, l_extendedprice * (1 - l_discount) AS paid_price,
                   l_extendedprice AS total_price,
                   CASE l_returnflag WHEN 'A' THEN 'Visa' WHEN 'N' THEN 'cash' ELSE 'MasterCard' END AS payment_method
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "sensors": """
            SELECT event_id, user_id AS sensor_id, ts AS timestamp, event_type AS location,
                   CASE WHEN event_id % 10 = 0 THEN 'inactive' ELSE 'active' END AS status, value,
                   CAST(event_id % 101 AS DOUBLE) AS battery_level, CAST(-(event_id % 90) AS DOUBLE) AS signal_strength
            FROM events""",
        "social": """
            SELECT c_custkey AS user_id, CAST(c_custkey % 1000 AS INT) AS follower_count,
                   CAST((c_custkey * 7) % 500 AS INT) AS following_count, c_custkey % 2 = 0 AS verified
            FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')""",
        "taxi": f"""
            SELECT pickup_at, {d.minutes("pickup_at", "l_quantity * 2 - 4")} AS dropoff_at,
                   CASE WHEN l_partkey % 97 = 0 THEN -1.0 * l_quantity ELSE l_quantity / 4.0 END AS trip_distance,
                   CASE WHEN l_partkey % 89 = 0 THEN 0.0 * l_quantity ELSE l_extendedprice END AS fare_amount,
                   CAST(10000 + l_suppkey % 20 AS INT) AS pickup_zip, CAST(10000 + l_partkey % 50 AS INT) AS dropoff_zip
            FROM (SELECT lineitem.*, {trip_start} AS pickup_at
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS rides""",
        "trips_raw": f"""
            SELECT CAST(l_orderkey AS {d.text}) || '-' || CAST(l_linenumber AS {d.text}) || '-'
                     || CAST(l_partkey AS {d.text}) AS ride_id,
                   CASE WHEN l_partkey % 2 = 0 THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
                   CASE WHEN l_partkey % 53 = 0 THEN 'not a time' ELSE {d.stamp("begun")} END AS started_at,
                   {d.stamp(d.minutes("begun", "l_quantity * 3 - 6"))} AS ended_at,
                   CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE cn.n_name END AS start_station_name,
                   CAST(cn.n_nationkey AS {d.text}) AS start_station_id,
                   sn.n_name AS end_station_name, CAST(sn.n_nationkey AS {d.text}) AS end_station_id,
                   CAST(cn.n_nationkey * 5 - 29.5 AS {d.text}) AS start_lat,
                   CAST(cn.n_nationkey * 2 + 0.25 AS {d.text}) AS start_lng,
                   CAST(sn.n_nationkey * 5 - 29.5 AS {d.text}) AS end_lat,
                   CAST(sn.n_nationkey * 2 + 0.25 AS {d.text}) AS end_lng,
                   CASE WHEN o_custkey % 3 = 0 THEN 'casual' ELSE 'member' END AS member_casual
            FROM (SELECT lineitem.*, o_custkey, {trip_start} AS begun
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS rides
            JOIN customer ON o_custkey = c_custkey JOIN nation AS cn ON c_nationkey = cn.n_nationkey
            JOIN supplier ON l_suppkey = s_suppkey JOIN nation AS sn ON s_nationkey = sn.n_nationkey""",
        "posts": f"""
            SELECT documents.doc_id,
                   CASE WHEN documents.doc_id % 41 = 0 THEN 'no date' ELSE
                     {d.feed_time(d.minutes(d.instant("2009-04-06 22:19:45"), "documents.doc_id"))} END AS date,
                   source AS user,
                   CASE WHEN documents.doc_id % 3 = 0 THEN '@User' || CAST(documents.doc_id % 7 AS {d.text}) || ': '
                          || text || ' @Été_' || CAST(documents.doc_id % 5 AS {d.text})
                        ELSE text END AS text,
                   CASE quality WHEN 0 THEN '0' WHEN 1 THEN '4' ELSE NULL END AS sentiment
            FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id""",
    }


HEAVY = ("trips_raw", "taxi", "posts")
SPARK_TEXTS = _texts(_Spark)
SQL_TEXTS = _texts(_Sql)


class Tables:
    """Attribute access to the test tables of one folder and to the tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def wide(self, name: str) -> DataFrame:
        """A test table spread over the cores."""
        return spread_out(getattr(self, name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(self.path(name))
        if name not in SPARK_TEXTS:
            raise AttributeError(name)
        used = [t for t in BASE_TABLES if t in SPARK_TEXTS[name].replace(",", " ").split()]
        with_frames = SPARK_TEXTS[name]
        # These are costly to derive, and the test files hold one row group each.
        views = {t: self.wide(t) if name in HEAVY and t in ("lineitem", "documents") else getattr(self, t) for t in used}
        header = ", ".join(f"{t} AS (SELECT * FROM {{{t}}})" for t in used)
        return self.spark.sql(f"WITH {header} {with_frames}", **views)


def sql_with(body: str, *names: str) -> str:
    """The check SQL with the derived tables it needs in front."""
    if not names:
        return body.strip()
    header = ", ".join(f"{name} AS ({SQL_TEXTS[name].strip()})" for name in names)
    return f"WITH {header} SELECT * FROM ({body.strip()}) AS result"
