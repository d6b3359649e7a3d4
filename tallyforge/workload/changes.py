"""Updates, deletes, merges and versions."""

from pyspark.sql import functions as F

from tallyforge.operators import changes
from tallyforge.plans import taxi
from tallyforge.session import shared_dir
from tallyforge.sources import states
from tallyforge.workload.registry import query, rounded


def with_large_fares(t):
    """Some fares don't fit the type that they are changed to, or only until they are raised."""
    zone = F.col("dropoff_zip")
    fare = F.when(zone == 10049, 1e9).when(zone == 10048, 95e6).otherwise(F.col("fare_amount"))
    return t.taxi.withColumn("fare_amount", fare)


@query(
    "mu01_update",
    """SELECT pickup_zip, dropoff_zip, CASE WHEN pickup_zip = 10001 AND hour(pickup_at) >= 17 AND hour(pickup_at) < 19
              THEN try_cast(try_cast(fare AS DECIMAL(10,2)) * CAST(1.10 AS DECIMAL(3,2)) AS DECIMAL(10,2))
              ELSE try_cast(fare AS DECIMAL(10,2)) END::VARCHAR AS fare
       FROM (SELECT *, CASE dropoff_zip WHEN 10049 THEN 1e9 WHEN 10048 THEN 95e6 ELSE fare_amount END AS fare FROM taxi)""",
    "taxi",
)
def update(t):
    priced = with_large_fares(t).withColumn("fare_amount", taxi.money("fare_amount"))
    return taxi.surge_pricing(priced, 10001).select("pickup_zip", "dropoff_zip", F.col("fare_amount").cast("string").alias("fare"))


@query(
    "mu02_delete",
    """SELECT pickup_zip, dropoff_zip, fare_amount FROM taxi
       WHERE NOT (fare_amount <= 0 OR trip_distance < 0 OR dropoff_at <= pickup_at)""",
    "taxi",
)
def delete(t):
    return taxi.without_invalid(taxi.with_durations(t.taxi)).select("pickup_zip", "dropoff_zip", "fare_amount")


MERGED = """SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal FROM customer
       UNION ALL SELECT -1 - c_custkey, 'new', c_acctbal + 1000 FROM customer WHERE c_mktsegment = 'MACHINERY'"""


def corrected_accounts(t, **options):
    """Accounts in debt are corrected, and accounts with new keys are added."""
    columns = ("c_custkey", "c_name", "c_acctbal")
    target = t.customer.select(*columns)
    raised = t.customer.withColumn("c_acctbal", F.col("c_acctbal") + 1000)
    corrections = raised.filter("c_acctbal < 1000").select(*columns)
    new = raised.filter("c_mktsegment = 'MACHINERY'").select(
        (-1 - F.col("c_custkey")).alias("c_custkey"), F.lit("new").alias("c_name"), "c_acctbal"
    )
    return changes.merge_into(target, corrections.union(new), ["c_custkey"], update=["c_acctbal"], **options)


@query("mu03_merge", MERGED)
def merge(t):
    return corrected_accounts(t)


@query("mu03b_merge_shuffled", MERGED)
def merge_shuffled(t):
    """The way of a source too large to be sent to the target."""
    return corrected_accounts(t, broadcast_rows=0)


@query(
    "mu04_add_columns",
    """SELECT pickup_zip, fare_amount, coalesce(minutes, -1) AS minutes FROM (
         SELECT pickup_zip, fare_amount, NULL::DOUBLE AS minutes FROM taxi
         UNION ALL SELECT pickup_zip, fare_amount, round((epoch(dropoff_at) - epoch(pickup_at)) / 60.0, 2)::DOUBLE FROM taxi
                   WHERE pickup_zip = 10002)""",
    "taxi",
)
def add_columns(t):
    old = t.taxi.select("pickup_zip", "fare_amount")
    more = taxi.with_durations(t.taxi.filter("pickup_zip = 10002")).select("pickup_zip", "fare_amount", "trip_duration_minutes")
    grown = changes.append_rows(old, more, evolve=True)
    return grown.select("pickup_zip", "fare_amount", F.coalesce("trip_duration_minutes", F.lit(-1.0)).alias("minutes"))


@query(
    "mu05_change_type",
    """SELECT pickup_zip, dropoff_zip, try_cast(fare AS DECIMAL(10,2))::VARCHAR AS fare FROM (
         SELECT *, row_number() OVER (PARTITION BY pickup_at, pickup_zip, dropoff_zip ORDER BY fare, dropoff_at) AS rn
         FROM (SELECT *, CASE dropoff_zip WHEN 10049 THEN 1e9 WHEN 10048 THEN 95e6 ELSE fare_amount END AS fare FROM taxi))
       WHERE rn = 1""",
    "taxi",
)
def change_type(t):
    decimals = taxi.fares_as_decimal(with_large_fares(t), F.col("fare_amount"), F.col("dropoff_at"))
    return decimals.select("pickup_zip", "dropoff_zip", F.col("fare_amount").cast("string").alias("fare"))


@query(
    "mu06_old_version",
    "SELECT s_suppkey, s_acctbal FROM supplier",
)
def old_version(t):
    """Version 0 still reads as it was after two changes."""
    path = shared_dir(t.spark, "suppliers")
    table = t.supplier.select("s_suppkey", "s_acctbal")
    states.write_state(table, path, 0, "create")
    poorer = changes.update_where(table, F.col("s_acctbal") > 0, {"s_acctbal": F.lit(0.0)})
    states.write_state(poorer, path, 1, "update")
    states.write_state(changes.delete_where(poorer, F.col("s_suppkey") > 3), path, 2, "delete")
    return states.read_state(t.spark, path, 0)


@query(
    "mu07_compare_versions",
    """SELECT 'Version 0' AS version, count(*) AS row_count, round(avg(fare_amount), 6) AS mean FROM taxi
       UNION ALL SELECT 'Current', count(*), round(avg(fare_amount), 6) FROM taxi WHERE fare_amount > 0""",
    "taxi",
)
def compare_versions(t):
    states = {"Version 0": t.taxi, "Current": changes.delete_where(t.taxi, F.col("fare_amount") <= 0)}
    return rounded(changes.compare_versions(states, "fare_amount"), mean=6)


@query(
    "mu08_history",
    """SELECT 0 AS version, 'create' AS operation, count(*) AS rows FROM part
       UNION ALL SELECT 1, 'delete', count(*) FROM part WHERE p_size <= 40""",
)
def history(t):
    path = shared_dir(t.spark, "parts")
    states.write_state(t.part, path, 0, "create")
    states.write_state(changes.delete_where(t.part, F.col("p_size") > 40), path, 1, "delete")
    return states.history(t.spark, path).select("version", "operation", "rows")


@query("mu09_compact", "SELECT l_orderkey, l_suppkey, l_extendedprice FROM lineitem")
def compact(t):
    path = shared_dir(t.spark, "lines")
    states.write_state(t.lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice").repartition(16), path, 0, "create")
    states.write_state(states.clustered(states.read_state(t.spark, path), "l_suppkey", 4), path, 1, "compact")
    return states.read_state(t.spark, path)


@query(
    "mu09b_compact_by_two_columns",
    "SELECT l_suppkey, strftime(l_shipdate, '%Y-%m') AS month, count(*) AS row_count, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1, 2",
)
def compact_by_two_columns(t):
    """Laid out so that filters on either column skip files; no row is lost or changed."""
    path = shared_dir(t.spark, "lines")
    lines = t.lineitem.select("l_suppkey", "l_shipdate", "l_extendedprice")
    states.write_state(states.clustered_by_all(lines, ["l_suppkey", "l_shipdate"], 16), path, 0, "compact")
    month = F.date_format("l_shipdate", "yyyy-MM").alias("month")
    table = states.read_state(t.spark, path).groupBy("l_suppkey", month).agg(F.count("*").alias("row_count"), F.sum("l_extendedprice").alias("total"))
    return rounded(table, total=2)
