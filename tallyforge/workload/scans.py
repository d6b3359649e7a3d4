"""Sources, sinks and partitioning: written from the test tables, read back, compared."""

from pyspark.sql import functions as F, types as T

from tallyforge.operators import layout, mergeable
from tallyforge.plans.trips import RAW_COLUMNS
from tallyforge.session import shared_dir
from tallyforge.sources import files, ingest, sinks, states
from tallyforge.streaming import views
from tallyforge.streaming.runners import append_to_files, finish
from tallyforge.workload.registry import query, r, stamp

PLAIN_CUSTOMERS = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def written(t, df, fmt: str, **options) -> str:
    path = shared_dir(t.spark, fmt)
    sinks.write_files(df, path, fmt, **options)
    return path


def land(t, stream):
    """Run a file stream into Parquet and read the result."""
    base = shared_dir(t.spark, "landed")
    finish(append_to_files(stream, f"{base}/data", f"{base}/checkpoint"))
    return t.spark.read.parquet(f"{base}/data")


@query("src01_csv_inferred", "SELECT c_custkey::INT AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_inferred(t):
    return files.read_csv(t.spark, written(t, t.customer, "csv"))


@query("src02_csv_declared", PLAIN_CUSTOMERS)
def csv_declared(t):
    return files.read_csv(t.spark, written(t, t.customer, "csv"), CUSTOMER_DDL)


@query(
    "src03_parquet_pushdown",
    "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'",
)
def parquet_pushdown(t):
    return t.lineitem.filter("l_quantity > 45 AND l_returnflag = 'R'").select("l_orderkey", "l_extendedprice")


@query("src04_json", PLAIN_CUSTOMERS)
def json_lines(t):
    return files.read_json(t.spark, written(t, t.customer, "json"), CUSTOMER_DDL)


@query(
    "src05_text_lines",
    "SELECT n_nationkey || ',' || n_name AS value FROM nation UNION ALL SELECT s_suppkey || ',' || s_name FROM supplier",
)
def text_lines(t):
    path = shared_dir(t.spark, "lines")
    suppliers = t.supplier.select(F.col("s_suppkey").cast("int").alias("n_nationkey"), F.col("s_name").alias("n_name"))
    header = t.spark.createDataFrame([("key", "name")], "n_nationkey STRING, n_name STRING")
    rows = t.nation.select(F.col("n_nationkey").cast("string").alias("n_nationkey"), "n_name").union(
        suppliers.withColumn("n_nationkey", F.col("n_nationkey").cast("string"))
    )
    sinks.write_lines(rows.union(header), path)
    return files.read_lines(t.spark, path, header="key,name")


@query("src06_table", "SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY 1")
def table_scan(t):
    t.orders.createOrReplaceTempView("orders_table")
    return t.spark.table("orders_table").groupBy("o_orderpriority").agg(F.count("*").alias("orders"))


@query(
    "src07_in_memory",
    "SELECT n_nationkey::BIGINT AS id, n_name, CASE n_regionkey WHEN 0 THEN 'first' WHEN 1 THEN 'second' ELSE 'other' END AS label FROM nation",
)
def in_memory(t):
    """A range up to the table's largest key and a few literal rows, joined with the table."""
    labels = t.spark.createDataFrame([(0, "first"), (1, "second")], "n_regionkey INT, label STRING")
    largest = t.nation.agg(F.max("n_nationkey")).first()[0]
    numbers = t.spark.range(0, largest + 1, numPartitions=4)
    named = numbers.join(t.nation, F.col("id") == F.col("n_nationkey")).join(labels, "n_regionkey", "left")
    return named.select("id", "n_name", F.coalesce("label", F.lit("other")).alias("label"))


@query("src09_current_state", "SELECT p_partkey, p_size FROM part WHERE p_size <= 25")
def current_state(t):
    path = shared_dir(t.spark, "state")
    parts = t.part.select("p_partkey", "p_size")
    states.write_state(parts, path, 0, "create")
    states.write_state(parts.filter("p_size <= 25"), path, 1, "delete")
    return states.read_state(t.spark, path)


@query("src10_stream_csv", "SELECT ride_id, started_at, start_lat, member_casual FROM trips_raw", "trips_raw")
def stream_csv(t):
    path = written(t, t.trips_raw.select(*RAW_COLUMNS), "csv")
    return land(t, ingest.stream_csv_strings(t.spark, path, RAW_COLUMNS)).select(
        "ride_id", "started_at", "start_lat", "member_casual"
    )


@query(
    "src11_stream_orders",
    """SELECT o_orderkey::VARCHAR AS order_id, o_custkey::INT AS customer_id, 3 AS quantity,
              round(o_totalprice, 2) AS amount, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_date
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def stream_orders(t):
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.lit("p").alias("product_id"), F.when(F.col("o_orderstatus") == "P", 0).otherwise(3).alias("quantity"),
        F.col("o_totalprice").alias("amount"), stamp("o_orderdate").alias("order_date"),
    )
    landed = land(t, ingest.stream_orders(t.spark, written(t, raw, "json")))
    return landed.select(
        "order_id", "customer_id", "quantity", F.col("amount").cast("double").alias("amount"), stamp("order_date").alias("order_date")
    )


@query("src12_stream_json", "SELECT date, source AS user, sentiment FROM posts JOIN documents USING (doc_id)", "posts")
def stream_json(t):
    path = written(t, t.posts.select("date", "user", "text", "sentiment"), "json")
    schema = ingest.inferred_json_schema(t.spark, path)
    return land(t, ingest.stream_json(t.spark, path, schema)).select("date", "user", "sentiment")


@query("src13_stream_table", "SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def stream_table(t):
    stream = ingest.stream_parquet(t.spark, t.folder, t.events.schema, max_files=1, name="events.parquet")
    return land(t, stream).select("event_id", "event_type", stamp("ts").alias("at"))


@query(
    "src14_rescue",
    "SELECT count(*) AS rows_read, count(*) FILTER (WHERE n_nationkey % 4 = 0) AS rescued FROM nation",
)
def rescue(t):
    path = shared_dir(t.spark, "misfits")
    line = F.concat_ws(",", F.col("n_nationkey").cast("string"), "n_name")
    misfit = F.concat(line, F.lit(",one,too,many"))
    t.nation.select(F.when(F.col("n_nationkey") % 4 == 0, misfit).otherwise(line).alias("value")).write.text(path)
    schema = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("name", T.StringType())])
    rows = files.read_csv_rescued(t.spark, path, schema, header=False)
    return rows.agg(F.count("key").alias("rows_read"), F.count(files.RESCUED).alias("rescued"))


MISFITS = """
    SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 3 = 0 THEN 'no ' || n_nationkey ELSE CAST(n_nationkey AS VARCHAR) END AS key,
           CASE WHEN n_nationkey % 2 = 0 THEN 'of ' || n_regionkey END AS extra FROM nation
"""


@query(
    "src14b_rescue_fields",
    f"""SELECT kind, TRY_CAST(key AS INTEGER) AS key, n_name AS name,
               CASE WHEN n_nationkey % 6 = 0 THEN '{{"key":"' || key || '","' || field || '":"' || extra || '"}}'
                    WHEN n_nationkey % 3 = 0 THEN '{{"key":"' || key || '"}}'
                    WHEN n_nationkey % 2 = 0 THEN '{{"' || field || '":"' || extra || '"}}' END AS _rescued
        FROM ({MISFITS}) CROSS JOIN (VALUES ('json', 'region'), ('csv', '_extra_1')) v(kind, field)""",
)
def rescue_fields(t):
    """JSON and CSV lines with a key of the wrong type, a field too many, or both: the row stays, only these fields are rescued."""
    path = shared_dir(t.spark, "fields")
    number = F.col("n_nationkey")
    key = F.when(number % 3 == 0, F.concat(F.lit("no "), number)).otherwise(number.cast("string"))
    extra = F.when(number % 2 == 0, F.concat(F.lit("of "), F.col("n_regionkey")))
    given = t.nation.select(key.alias("key"), F.col("n_name").alias("name"), extra.alias("region"))
    given.write.json(f"{path}/json")  # leaves out what is NULL
    given.select(F.concat_ws(",", "key", "name", "region").alias("value")).write.text(f"{path}/csv")
    schema = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("name", T.StringType())])
    parts = {kind: read(files.read_lines(t.spark, f"{path}/{kind}"), schema) for kind, read in (("json", files.json_by_field), ("csv", files.csv_by_field))}
    both = [part.withColumn("kind", F.lit(kind)) for kind, part in parts.items()]
    return both[0].unionByName(both[1])


@query("src15_lineage", "SELECT 'events.parquet' AS file, count(*) AS row_count FROM events")
def lineage(t):
    traced = files.with_lineage(t.events).filter(F.col("_ingested_at").isNotNull())
    return traced.groupBy(F.element_at(F.split("_source_file", "/"), -1).alias("file")).agg(F.count("*").alias("row_count"))


@query(
    "src16_split_fields",
    "SELECT c_custkey AS key, c_name AS name, CASE WHEN c_custkey % 9 = 0 THEN -1.0 ELSE c_acctbal END::DOUBLE AS balance FROM customer",
)
def split_fields(t):
    balance = F.when(F.col("c_custkey") % 9 == 0, "broken").otherwise(F.col("c_acctbal").cast("string"))
    lines = t.customer.select(
        F.concat_ws(",", F.col("c_custkey").cast("string"), F.concat(F.lit('"'), "c_name", F.lit('"')), balance).alias("value")
    )
    fields = files.split_fields(lines, "key BIGINT, name STRING, balance DOUBLE")
    return fields.select("key", "name", F.coalesce("balance", F.lit(-1.0)).alias("balance"))


@query(
    "snk01_formats_agree",
    """SELECT fmt, count(*) AS row_count, round(sum(p_retailprice), 2) AS total FROM part, (VALUES ('csv'), ('json'), ('parquet')) f(fmt) GROUP BY 1""",
)
def formats_agree(t):
    ddl = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    result = None
    for fmt in ("csv", "json", "parquet"):
        reader = t.spark.read.schema(ddl).option("header", True).format(fmt)
        part = reader.load(written(t, t.part, fmt)).agg(
            F.lit(fmt).alias("fmt"), F.count("*").alias("row_count"), r(F.sum("p_retailprice")).alias("total")
        )
        result = part if result is None else result.unionByName(part)
    return result


@query("snk02_append", "SELECT n_name FROM nation UNION ALL SELECT n_name FROM nation WHERE n_regionkey = 1")
def append(t):
    path = written(t, t.nation, "parquet")
    sinks.write_files(t.nation.filter("n_regionkey = 1"), path, mode="append")
    return t.spark.read.parquet(path).select("n_name")


@query("snk03_partitioned", "SELECT o_orderstatus, count(*) AS row_count FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def partitioned(t):
    """The filter on the partition column reads one folder."""
    path = written(t, t.orders, "parquet", partition_by=["o_orderstatus"])
    read = t.spark.read.parquet(path).filter("o_orderstatus = 'F'")
    return read.groupBy("o_orderstatus").agg(F.count("*").alias("row_count"))


@query("snk04_file_count", "SELECT 3 AS files_even, 2 AS files_merged, count(*) AS row_count FROM orders")
def file_count(t):
    even = t.spark.read.parquet(written(t, t.orders, "parquet", files=3))
    merged = t.spark.read.parquet(written(t, t.orders.repartition(8), "parquet", files=2, even=False))
    return even.agg(
        F.lit(len(even.inputFiles())).alias("files_even"), F.lit(len(merged.inputFiles())).alias("files_merged"),
        F.count("*").alias("row_count"),
    )


@query("snk05_text", "SELECT r_regionkey || ',' || r_name AS value FROM region")
def text_rows(t):
    path = shared_dir(t.spark, "text")
    sinks.write_lines(t.region, path)
    return t.spark.read.text(path)


@query("snk09_view", "SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def materialized_view(t):
    """A view that is refreshed from the files that are new: first from three quarters of the orders, then from the rest."""
    base = shared_dir(t.spark, "view")
    measures = {"orders": mergeable.row_count(), "total": mergeable.total("o_totalprice")}
    late = F.pmod(F.xxhash64("o_orderkey"), F.lit(4)) == 0
    for part in (~late, late):
        t.orders.where(part).write.mode("append").parquet(f"{base}/in")
        stream = ingest.stream_parquet(t.spark, f"{base}/in", t.orders.schema)
        finish(views.refresh_view(stream, f"{base}/view", f"{base}/checkpoint", ["o_orderstatus"], measures))
    return views.read_view(t.spark, f"{base}/view", measures).withColumn("total", r("total"))


@query("snk10_temp_view", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1")
def temp_view(t):
    t.customer.createOrReplaceTempView("customer_view")
    return t.spark.sql("SELECT c_mktsegment, count(*) AS customers FROM customer_view GROUP BY c_mktsegment")


@query("snk11_typed_table", "SELECT n_nationkey::BIGINT AS key, n_name AS name FROM nation")
def typed_table(t):
    path = shared_dir(t.spark, "typed")
    name = "typed_nations"
    t.spark.sql(f"DROP TABLE IF EXISTS {name}")
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("name", T.StringType())])
    sinks.create_table(t.spark, name, schema, path)
    sinks.write_table(t.nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("key")), name)
    return t.spark.table(name)


@query("pt01_repartition", "SELECT 16 AS partitions, count(*) AS row_count FROM events UNION ALL SELECT 4, count(*) FROM events")
def repartition(t):
    up = t.events.repartition(16)
    down = up.coalesce(4)
    return up.agg(F.lit(up.rdd.getNumPartitions()).alias("partitions"), F.count("*").alias("row_count")).union(
        down.agg(F.lit(down.rdd.getNumPartitions()), F.count("*"))
    )


@query("pt02_partition_sizes", "SELECT 8 AS partitions, count(*) AS row_count, 40 AS sampled FROM events")
def partition_sizes(t):
    spread = t.events.select("event_id").repartition(8)
    sampled = layout.partition_sample(spread, 5).agg(F.count("*").cast("int").alias("sampled"))
    sizes = layout.partition_sizes(spread).agg(F.count("*").cast("int").alias("partitions"), F.sum("row_count").alias("row_count"))
    return sizes.select("partitions", "row_count", sampled.scalar().alias("sampled"))


@query("pt03_by_key", "SELECT user_id, 1 AS partitions FROM events GROUP BY 1")
def by_key(t):
    placed = layout.by_key(t.events, 8, "user_id").select("user_id", F.spark_partition_id().alias("p"))
    return placed.groupBy("user_id").agg(F.count_distinct("p").cast("int").alias("partitions"))


@query(
    "pt04_kept",
    "SELECT event_type, count(*) AS row_count, round(sum(value), 2) AS total FROM events WHERE value > 20 GROUP BY 1",
)
def kept(t):
    filtered = t.events.filter("value > 20").select("event_type", "value")
    path = shared_dir(t.spark, "kept")
    with layout.kept(filtered) as held:
        counts = held.groupBy("event_type").agg(F.count("*").alias("row_count"))
        sums = held.groupBy("event_type").agg(r(F.sum("value")).alias("total"))
        sinks.write_files(counts.join(sums, "event_type"), path)
    return t.spark.read.parquet(path)
