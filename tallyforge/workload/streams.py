"""Streaming queries over the test tables, run until all is read, then read back."""

from pyspark.sql import functions as F

from tallyforge.functions import tiers
from tallyforge.operators import mergeable, models
from tallyforge.plans import orders as order_plan, posts as post_plan, trips as trip_plan
from tallyforge.plans.steps import refresh
from tallyforge.session import shared_dir
from tallyforge.sources import ingest, sinks, states
from tallyforge.streaming import metrics, replay, runners, upsert, views
from tallyforge.workload.registry import query, r, rounded, stamp


def event_stream(t):
    return ingest.stream_parquet(t.spark, t.folder, t.events.schema, name="events.parquet")


def appended(t, stream):
    base = shared_dir(t.spark, "appended")
    runners.finish(runners.append_to_files(stream, f"{base}/data", f"{base}/checkpoint"))
    return t.spark.read.schema(stream.schema).parquet(f"{base}/data")


def replaced(t, stream):
    base = shared_dir(t.spark, "replaced")
    runners.finish(runners.replace_result(stream, f"{base}/table", f"{base}/checkpoint"))
    return states.read_state(t.spark, f"{base}/table")


def hourly(t):
    late = metrics.with_lateness(event_stream(t), "ts")
    return metrics.windowed_totals(late, "ts", ["event_type"], "value")


CLOSED_HOURS = """
    SELECT date_trunc('hour', ts) AS w, event_type, count(*) AS n, sum(value) AS s, avg(value) AS a FROM events
    GROUP BY 1, 2 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
"""


@query("snk06_append_sink", "SELECT event_id, event_type, value FROM events")
def append_sink(t):
    return appended(t, event_stream(t).select("event_id", "event_type", "value"))


@query("snk07_complete_sink", "SELECT event_type, count(*) AS row_count FROM events GROUP BY 1")
def complete_sink(t):
    return replaced(t, event_stream(t).groupBy("event_type").agg(F.count("*").alias("row_count")))


@query(
    "snk08_stream_table",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, n_name AS region, count(*) AS order_count, round(sum(o_totalprice), 2) AS total_revenue,
              count(DISTINCT o_custkey) AS unique_customers
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN customers ON c_custkey = customer_id WHERE email IS NOT NULL AND o_orderstatus <> 'P' GROUP BY 1, 2""",
    "customers",
)
def order_flow(t):
    """Order files and a customer file through streams and views to the daily summary."""
    base = shared_dir(t.spark, "orders")
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.lit("p").alias("product_id"), F.when(F.col("o_orderstatus") == "P", 0).otherwise(3).alias("quantity"),
        F.col("o_totalprice").alias("amount"), stamp("o_orderdate").alias("order_date"),
    )
    people = t.customers.select(
        "customer_id", F.when(F.col("email").isNotNull(), F.col("name")).alias("name"), "email",
        F.col("state").alias("region"), "signup_date",
    )
    sinks.write_files(raw, f"{base}/in/orders", "json")
    sinks.write_files(people, f"{base}/in/customers", "csv")
    read = refresh(t.spark, f"{base}/out", order_plan.flow(f"{base}/in/orders", f"{base}/in/customers"))
    return read("daily_order_summary").select(
        F.date_format("order_date", "yyyy-MM-dd").alias("order_date"), "region", "order_count",
        r(F.col("total_revenue").cast("double")).alias("total_revenue"), "unique_customers",
    )


@query("sm01_available_now", "SELECT count(*) AS row_count, count(DISTINCT event_id) AS distinct_rows FROM events")
def available_now(t):
    """A second run over the same files adds nothing."""
    base = shared_dir(t.spark, "rerun")
    for _ in range(2):
        stream = event_stream(t).select("event_id")
        runners.finish(runners.append_to_files(stream, f"{base}/data", f"{base}/checkpoint"))
    return t.spark.read.parquet(f"{base}/data").agg(
        F.count("*").alias("row_count"), F.count_distinct("event_id").alias("distinct_rows")
    )


@query(
    "sm02_late_rows",
    """WITH first AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events WHERE event_type <> 'error'),
       kept AS (SELECT date_trunc('hour', ts) AS w FROM events, first
                WHERE event_type <> 'error' OR date_trunc('hour', ts) + INTERVAL 1 HOUR > mark)
       SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS transaction_count FROM kept
       WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY 1""",
)
def late_rows(t):
    """Errors arrive after all other events: those of closed hours come too late and are dropped."""
    base = shared_dir(t.spark, "late")
    for part in ("event_type <> 'error'", "event_type = 'error'"):
        sinks.write_files(t.events.filter(part), f"{base}/in", mode="append")
        stream = ingest.stream_parquet(t.spark, f"{base}/in", t.events.schema)
        windows = metrics.windowed_totals(metrics.with_lateness(stream, "ts"), "ts", [], "value")
        runners.finish(runners.append_to_files(windows, f"{base}/data", f"{base}/checkpoint"))
    closed = t.spark.read.parquet(f"{base}/data")
    return closed.select(stamp("window_start").alias("window_start"), "transaction_count")


@query(
    "sm03_hourly_windows",
    f"SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, n AS transaction_count, round(s, 2) AS total_sales, round(a, 6) AS avg_transaction_value FROM ({CLOSED_HOURS})",
)
def hourly_windows(t):
    closed = appended(t, hourly(t)).drop("window_end").withColumn("window_start", stamp("window_start"))
    return rounded(closed, total_sales=2, avg_transaction_value=6)


@query(
    "sm04_window_bounds",
    f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, event_type
        FROM ({CLOSED_HOURS})""",
)
def window_bounds(t):
    return appended(t, hourly(t)).select(stamp("window_start").alias("window_start"), stamp("window_end").alias("window_end"), "event_type")


def tagged(t):
    return event_stream(t).withColumn("traffic_source", tiers.shares(F.col("event_id"), tiers.TRAFFIC_SOURCES))


TAGGED = """
    SELECT *, CASE WHEN event_id % 100 < 40 THEN 'walk-in' WHEN event_id % 100 < 65 THEN 'online-order'
              WHEN event_id % 100 < 85 THEN 'delivery-app' WHEN event_id % 100 < 95 THEN 'phone-order' ELSE 'social-media' END AS traffic_source
    FROM events
"""


@query(
    "sm05_totals_by_source",
    f"""SELECT traffic_source, event_type, round(sum(value), 2) AS total_revenue, count(*) AS transaction_count,
               round(avg(value), 6) AS avg_order_value FROM ({TAGGED}) GROUP BY 1, 2""",
)
def totals_by_source(t):
    totals = metrics.totals_by(tagged(t), ["traffic_source", "event_type"], "value")
    return rounded(replaced(t, totals), total_revenue=2, avg_order_value=6)


@query(
    "sm06_sorted",
    f"""SELECT traffic_source, round(sum(value), 2) AS total_revenue FROM ({TAGGED}) GROUP BY 1 ORDER BY 2 DESC""",
)
def sorted_result(t):
    totals = metrics.totals_by(tagged(t), ["traffic_source"], "value").orderBy(F.desc("total_revenue"))
    return rounded(replaced(t, totals), total_revenue=2).select("traffic_source", "total_revenue").orderBy(F.desc("total_revenue"))


@query(
    "sm07_filter_and_project",
    f"SELECT event_id, event_type IN ('click', 'view') AS is_visit, value FROM ({TAGGED}) WHERE traffic_source = 'walk-in'",
)
def filter_and_project(t):
    visits = tagged(t).filter("traffic_source = 'walk-in'").withColumn("is_visit", F.col("event_type").isin("click", "view"))
    return appended(t, visits.select("event_id", "is_visit", "value"))


@query(
    "sm08_stream_static",
    "SELECT event_id, event_type, name AS customer_name, state FROM events JOIN customers ON user_id = customer_id",
    "customers",
)
def stream_static(t):
    people = t.customers.select(
        F.col("customer_id").alias("user_id"), F.col("name").alias("customer_name"), "state"
    )
    enriched = metrics.enrich(event_stream(t), people, "user_id", ["customer_name", "state"])
    return appended(t, enriched.select("event_id", "event_type", "customer_name", "state"))


@query(
    "sm09_running_totals",
    """SELECT event_type, round(sum(value), 2) AS total_sales, count(*) AS total_transactions, count(DISTINCT user_id) AS unique_customers,
              true AS close FROM events GROUP BY 1""",
)
def running_totals(t):
    """Totals kept in a view, by a stream over the first batches and one with a new checkpoint over the others.

    Sums and counts are exact; distinct customers are a sketch, within three relative deviations.
    """
    base = shared_dir(t.spark, "totals")
    replay.write_ordered_batches(t.events, f"{base}/in", "ts", "event_id")
    measures = metrics.running_measures("value", "user_id")
    for name, folders in (("first", "batch=[012]"), ("second", "batch=[34]")):
        stream = ingest.stream_parquet(t.spark, f"{base}/in/{folders}", t.events.schema, max_files=1)
        runners.finish(views.refresh_view(stream, f"{base}/view", f"{base}/{name}", ["event_type"], measures, name))
    totals = views.read_view(t.spark, f"{base}/view", measures)
    exact = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    close = F.abs(F.col("unique_customers") - F.col("exact")) <= F.ceil(3 * mergeable.DISTINCT_ERROR * F.col("exact"))
    return totals.join(exact, "event_type").select(
        "event_type", r("total_sales").alias("total_sales"), "total_transactions", F.col("exact").alias("unique_customers"), close.alias("close")
    )


@query(
    "sm10_three_queries",
    f"""SELECT 'by_type' AS query, count(DISTINCT event_type) AS row_count FROM events
        UNION ALL SELECT 'by_source', count(DISTINCT traffic_source) FROM ({TAGGED})
        UNION ALL SELECT 'hourly', count(*) FROM ({CLOSED_HOURS})""",
)
def three_queries(t):
    """Three queries over one source, side by side, each with its own checkpoint."""
    base = shared_dir(t.spark, "dashboard")
    by_type = metrics.totals_by(event_stream(t), ["event_type"], "value")
    by_source = metrics.totals_by(tagged(t), ["traffic_source"], "value")
    runners.finish_all(
        {
            "by_type": lambda: runners.replace_result(by_type, f"{base}/by_type", f"{base}/c1"),
            "by_source": lambda: runners.replace_result(by_source, f"{base}/by_source", f"{base}/c2"),
            "hourly": lambda: runners.append_to_files(hourly(t), f"{base}/hourly", f"{base}/c3"),
        }
    )
    tables = {
        "by_type": states.read_state(t.spark, f"{base}/by_type"),
        "by_source": states.read_state(t.spark, f"{base}/by_source"),
        "hourly": t.spark.read.parquet(f"{base}/hourly"),
    }
    result = None
    for name, table in tables.items():
        part = table.agg(F.lit(name).alias("query"), F.count("*").alias("row_count"))
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "sm12_upsert",
    """SELECT user_id, event_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def upserted(t):
    """Events arrive in five time-ordered batches; the table keeps each user's newest."""
    base = shared_dir(t.spark, "upsert")
    files = replay.write_ordered_batches(t.events, f"{base}/in", "ts", "event_id")
    stream = replay.replay(t.spark, f"{base}/in", t.events.schema, files)
    newest = [F.desc("ts"), F.desc("event_id")]
    runners.finish(upsert.upsert_stream(stream, f"{base}/table", f"{base}/checkpoint", ["user_id"], newest))
    return upsert.read_upserted(t.spark, f"{base}/table").select("user_id", "event_id", "event_type", "value")


@query(
    "sm13_three_layers",
    """SELECT strftime(week_start, '%Y-%m-%d') AS week_start, departures, arrivals FROM (
         WITH c AS (SELECT *, try_cast(started_at AS TIMESTAMP) AS started, try_cast(ended_at AS TIMESTAMP) AS ended FROM trips_raw
                    WHERE start_station_name IS NOT NULL AND start_lat::DOUBLE <= 90 AND end_lat::DOUBLE <= 90),
              g AS (SELECT * FROM c WHERE epoch(ended) - epoch(started) > 0)
         SELECT coalesce(d.w, a.w) AS week_start, coalesce(d.n, 0) AS departures, coalesce(a.n, 0) AS arrivals
         FROM (SELECT date_trunc('week', started) AS w, count(*) AS n FROM g WHERE start_station_name = 'NATION_3' GROUP BY 1) d
         FULL JOIN (SELECT date_trunc('week', ended) AS w, count(*) AS n FROM g WHERE end_station_name = 'NATION_3' GROUP BY 1) a
           ON d.w = a.w)""",
    "trips_raw",
)
def three_layers(t):
    """Raw trip files through bronze and silver streams to the weekly view."""
    base = shared_dir(t.spark, "trips")
    sinks.write_files(t.trips_raw, f"{base}/in", "csv")
    read = refresh(t.spark, f"{base}/out", trip_plan.flow(f"{base}/in", "NATION_3"))
    return read("weekly_counts").select(
        F.date_format("week_start", "yyyy-MM-dd").alias("week_start"), "departures", "arrivals"
    )


@query(
    "sm13b_post_layers",
    """SELECT mention, count(*) AS total, true AS adds_up FROM (
         SELECT lower(unnest(regexp_extract_all(text, '@[\\p{L}\\p{N}_]+'))) AS mention FROM posts) GROUP BY 1""",
    "posts",
)
def post_layers(t):
    """Post files through three streams to the view per mention; the stream scores with a classifier that is loaded, not trained."""
    base = shared_dir(t.spark, "posts")
    sinks.write_files(t.posts.select("date", "user", "text", "sentiment"), f"{base}/in", "json")
    labelled = t.documents.join(t.labels, "doc_id").select(F.col("text").alias("cleaned_text"), "quality")
    model = models.trained_once(t.spark, f"{base}/model", lambda: models.fit_text_classifier(labelled, "cleaned_text", "quality"))
    read = refresh(t.spark, f"{base}/out", post_plan.flow(f"{base}/in", lambda rows: models.score_sentiment(model, rows)))
    adds_up = (F.col("positive") + F.col("negative") == F.col("total")).alias("adds_up")
    return read("sentiment_by_mention").select("mention", "total", adds_up)


@query(
    "sm14_across_keys",
    f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, sum(n)::BIGINT AS total_transactions, round(sum(s), 2) AS total_revenue
        FROM ({CLOSED_HOURS}) GROUP BY 1""",
)
def across_keys(t):
    totals = metrics.across_keys(appended(t, hourly(t))).drop("window_end").withColumn("window_start", stamp("window_start"))
    return rounded(totals, total_revenue=2)


@query(
    "sm15_replay",
    f"SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, n AS transaction_count FROM ({CLOSED_HOURS})",
)
def replayed(t):
    """In five batches in time order, the windows are the same as in one batch: nothing is late."""
    base = shared_dir(t.spark, "replay")
    files = replay.write_ordered_batches(t.events, f"{base}/in", "ts", "event_id")
    late = metrics.with_lateness(replay.replay(t.spark, f"{base}/in", t.events.schema, files), "ts")
    closed = appended(t, metrics.windowed_totals(late, "ts", ["event_type"], "value"))
    return closed.select(stamp("window_start").alias("window_start"), "event_type", "transaction_count")


@query("sm11_progress", "SELECT count(*) AS input_rows, count(*) AS observed_rows, false AS still_active FROM events")
def followed(t):
    """What a finished query reports about itself."""
    base = shared_dir(t.spark, "followed")
    watched = event_stream(t).observe("seen", F.count("*").alias("n"))
    with runners.counted(t.spark) as totals:
        query = runners.finish(runners.append_to_files(watched.select("event_id"), f"{base}/data", f"{base}/checkpoint", name="followed"))
        total = totals.of(query)
    facts = (total["input_rows"], total["observed"]["seen"]["n"], query.isActive)
    return t.spark.createDataFrame([facts], "input_rows LONG, observed_rows LONG, still_active BOOLEAN")


@query("sm16_update_mode", "SELECT user_id, count(*) AS row_count FROM events GROUP BY 1")
def update_mode(t):
    """Each trigger sends the keys it changed; the last value sent per key is the total."""
    base = shared_dir(t.spark, "updates")
    files = replay.write_ordered_batches(t.events, f"{base}/in", "ts", "event_id", batches=3)
    counts = replay.replay(t.spark, f"{base}/in", t.events.schema, files).groupBy("user_id").agg(F.count("*").alias("n"))

    def save(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/data/batch={batch_id}")

    runners.finish(runners.update_with(counts, save, f"{base}/checkpoint"))
    sent = t.spark.read.parquet(f"{base}/data")
    return sent.groupBy("user_id").agg(F.max_by("n", "batch").alias("row_count"))
