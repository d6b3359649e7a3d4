"""Streams: restarts, lateness, modes, upserts, flows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyforge.plans import orders, posts, trips
from tallyforge.plans.steps import Step, refresh
from tallyforge.sources import states
from tallyforge.sources.ingest import stream_parquet
from tallyforge.streaming import metrics, replay, runners, upsert

START = dt.datetime(2024, 1, 1)
SCHEMA = "id LONG, at TIMESTAMP, shop STRING, price DOUBLE"


def sales(spark, minutes, first_id=0):
    return spark.createDataFrame(
        [(first_id + i, START + dt.timedelta(minutes=m), f"s{i % 2}", float(i)) for i, m in enumerate(minutes)], SCHEMA
    ).coalesce(1)


def source(spark, path, **options):
    return stream_parquet(spark, path, spark.createDataFrame([], SCHEMA).schema, **options)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    path = str(tmp_path / "in")
    base = str(tmp_path / "out")
    for minutes, first in (([5, 20, 200], 0), ([6, 400], 10), ([7, 401], 20)):
        sales(spark, minutes, first).write.mode("append").parquet(path)
        windows = metrics.windowed_totals(metrics.with_lateness(source(spark, path), "at"), "at", [], "price")
        with runners.counted(spark) as totals:
            query = runners.finish(runners.append_to_files(windows, f"{base}/d", f"{base}/c"))
            late = totals.of(query)["late_rows"]
    closed = {r["window_start"]: r["transaction_count"] for r in spark.read.parquet(f"{base}/d").collect()}
    # The row at minute 6 came after the watermark had passed its hour.
    assert closed[START] == 2
    assert START + dt.timedelta(hours=6) not in closed
    assert late == 1


def test_update_mode_sends_changed_keys_only(spark, tmp_path):
    path, seen = str(tmp_path / "in"), []
    for minutes, first in (([1, 2], 0), ([3], 10)):
        sales(spark, minutes, first).write.mode("append").parquet(path)
        counts = source(spark, path).groupBy("shop").agg(F.count("*").alias("n"))
        query = runners.update_with(
            counts, lambda batch, i: seen.append(sorted(tuple(r) for r in batch.collect())), str(tmp_path / "c")
        )
        runners.finish(query)
    assert [s for s in seen if s] == [[("s0", 1), ("s1", 1)], [("s0", 2)]]


def test_interval_trigger_runs_until_stopped(spark, tmp_path):
    path, base = str(tmp_path / "in"), str(tmp_path / "out")
    sales(spark, [1, 2]).write.parquet(path)
    query = runners.append_to_files(source(spark, path), f"{base}/d", f"{base}/c", every="1 second", name="ticking")
    query.processAllAvailable()
    assert "ticking" in runners.active_names(spark) and query.isActive
    runners.stop_all(spark)
    assert not spark.streams.active
    assert spark.read.parquet(f"{base}/d").count() == 2


def test_complete_mode_replaces_the_result(spark, tmp_path):
    path, base = str(tmp_path / "in"), str(tmp_path / "out")
    for minutes, first in (([1, 2], 0), ([3, 4, 5], 10)):
        sales(spark, minutes, first).write.mode("append").parquet(path)
        totals = metrics.totals_by(source(spark, path), ["shop"], "price")
        runners.finish(runners.replace_result(totals, f"{base}/t", f"{base}/c"))
    result = {r["shop"]: r["transaction_count"] for r in states.read_state(spark, f"{base}/t").collect()}
    assert result == {"s0": 3, "s1": 2}


def test_progress_reports_input_rows_and_observed_metrics(spark, tmp_path):
    path, base = str(tmp_path / "in"), str(tmp_path / "out")
    sales(spark, [1, 2, 3]).write.parquet(path)
    watched = source(spark, path).observe("seen", F.count("*").alias("n"))
    with runners.counted(spark) as totals:
        total = totals.of(runners.finish(runners.append_to_files(watched, f"{base}/d", f"{base}/c")))
    assert total["input_rows"] == 3 and total["observed"] == {"seen": {"n": 3}}


def test_all_triggers_are_counted(spark, tmp_path):
    """More triggers than a query remembers by itself."""
    path, base = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(0, 130, 1, numPartitions=130).write.parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    stream = stream_parquet(spark, path, spark.range(0).schema, max_files=1).observe("seen", F.count("*").alias("n"))
    with runners.counted(spark) as totals:
        total = totals.of(runners.finish(runners.append_to_files(stream, f"{base}/d", f"{base}/c")))
    assert files > 100 and total["triggers"] >= files and total["input_rows"] == 130 and total["observed"]["seen"]["n"] == 130


@pytest.mark.parametrize("at_once", [True, False])
def test_results_do_not_depend_on_running_at_once(spark, tmp_path, at_once):
    path, base = str(tmp_path / "in"), str(tmp_path / "out")
    sales(spark, range(20)).write.parquet(path)
    runners.finish_all(
        {
            "all": lambda: runners.append_to_files(source(spark, path), f"{base}/a", f"{base}/c1"),
            "dear": lambda: runners.append_to_files(source(spark, path).filter("price > 9"), f"{base}/b", f"{base}/c2"),
        },
        at_once=at_once,
    )
    assert spark.read.parquet(f"{base}/a").count() == 20
    assert spark.read.parquet(f"{base}/b").count() == 10


def test_upsert_keeps_the_newest_of_each_key(spark, rows, tmp_path):
    path, base = str(tmp_path / "in"), str(tmp_path / "out")
    sales(spark, [1, 2, 3]).write.parquet(path)

    def run():
        stream = source(spark, path).select("shop", "id", "at")
        runners.finish(
            upsert.upsert_stream(stream, f"{base}/t", f"{base}/c", ["shop"], [F.desc("at")])
        )
        return rows(upsert.read_upserted(spark, f"{base}/t").select("shop", "id"))

    assert run() == [("s0", 2), ("s1", 1)]
    assert run() == [("s0", 2), ("s1", 1)]
    sales(spark, [9], 70).write.mode("append").parquet(path)
    assert run() == [("s0", 70), ("s1", 1)]


def keyed(spark, first, last, value):
    return spark.range(first, last).select(F.col("id").alias("k"), F.lit(value).alias("v"))


def rows_by_file(spark, path):
    table = spark.read.parquet(f"{path}/table")
    return {r[0]: r[1] for r in table.groupBy(F.input_file_name()).count().collect()}


def test_upsert_rewrites_only_the_buckets_of_a_batch(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    upsert.upsert_batch(keyed(spark, 0, 2000, "old"), 0, path, ["k"], [F.desc("v")], bucket_rows=150)
    before = set(spark.read.parquet(f"{path}/table").inputFiles())
    change = spark.createDataFrame([(7, "new"), (100_000, "new")], "k LONG, v STRING")
    upsert.upsert_batch(change, 1, path, ["k"], [F.desc("v")], bucket_rows=150)
    after = set(spark.read.parquet(f"{path}/table").inputFiles())
    assert len(before) >= 16 and 0 < len(before - after) <= 2 and len(before & after) >= 14
    assert sorted(rows(upsert.read_upserted(spark, path).where("v = 'new'"))) == [(7, "new"), (100_000, "new")]
    assert upsert.read_upserted(spark, path).count() == 2001
    assert not list((tmp_path / "t" / "staged").glob("*"))


def test_upsert_splits_buckets_as_they_grow(spark, rows, tmp_path):
    """Through several doublings; only buckets that grow are split, and keys are found in buckets of any depth."""
    path, want, counts = str(tmp_path / "t"), {}, []
    for number, (first, last) in enumerate([(0, 90), (60, 260), (200, 900), (0, 30), (850, 2000)]):
        upsert.upsert_batch(keyed(spark, first, last, number), number, path, ["k"], [F.desc("v")], bucket_rows=100)
        want.update({k: number for k in range(first, last)})
        assert dict(rows(upsert.read_upserted(spark, path))) == want
        assert upsert.read_upserted(spark, path).count() == len(want)
        counts.append(len(upsert._folders(spark, f"{path}/table")))
    assert counts[0] == 1 and counts[1] >= 2 and counts[2] >= 2 * counts[1] and counts[4] >= 16
    sizes = [r["count"] for r in spark.read.parquet(f"{path}/table").groupBy("bits", "bucket").count().collect()]
    assert max(sizes) < 200


def test_upsert_bounds_what_a_task_writes(spark, tmp_path):
    """One bucket of many rows has several writers."""
    path = str(tmp_path / "t")
    upsert.upsert_batch(keyed(spark, 0, 20_000, "a"), 0, path, ["k"], [F.desc("v")], bucket_rows=50_000, task_rows=2_000)
    sizes = rows_by_file(spark, path)
    assert len(sizes) >= 10 and max(sizes.values()) <= 2_000 and sum(sizes.values()) == 20_000


def test_upsert_plan_gives_every_bucket_its_writers():
    plan = upsert._plan({(1, 0): 10, (1, 1): 500, (3, 5): 90}, {(1, 0): 80, (1, 1): 700}, bucket_rows=100, task_rows=300)
    assert [p[:3] for p in plan] == [(1, 0, 1), (1, 1, 5), (3, 5, 3)]
    assert [p[3:] for p in plan] == [(0, 1), (1, 8), (9, 1)]


@pytest.mark.parametrize("moved", [0, 1, 3, 100])
def test_upsert_repeats_a_batch_that_died_while_moving(spark, rows, tmp_path, monkeypatch, moved):
    """A batch ends after some of its folders were put in place or taken away, and comes again."""
    path = str(tmp_path / "t")
    upsert.upsert_batch(keyed(spark, 0, 300, 0), 0, path, ["k"], [F.desc("v")], bucket_rows=100)
    left, real = [moved], upsert.remove

    def dying(session, folder):
        if left[0] == 0:
            raise RuntimeError("lost")
        left[0] -= 1
        real(session, folder)

    more = keyed(spark, 200, 700, 1)
    monkeypatch.setattr(upsert, "remove", dying)
    try:
        upsert.upsert_batch(more, 1, path, ["k"], [F.desc("v")], bucket_rows=100)
    except RuntimeError:
        pass
    monkeypatch.setattr(upsert, "remove", real)
    upsert.upsert_batch(more, 1, path, ["k"], [F.desc("v")], bucket_rows=100)
    assert dict(rows(upsert.read_upserted(spark, path))) == {k: int(k >= 200) for k in range(700)}
    assert upsert.read_upserted(spark, path).count() == 700


def test_upsert_takes_columns_that_have_no_hash(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = keyed(spark, 0, 50, "a").withColumn("m", F.create_map(F.lit("x"), F.col("k")))
    for number in range(2):
        upsert.upsert_batch(rows, number, path, ["k"], [F.desc("v")], bucket_rows=20, task_rows=5)
    assert {r.k: r.m for r in upsert.read_upserted(spark, path).collect()} == {k: {"x": k} for k in range(50)}


def test_upsert_of_empty_batches_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.upsert_batch(keyed(spark, 0, 0, "a"), 0, path, ["k"], [F.desc("v")])
    nulls = spark.createDataFrame([(None, "x"), (None, "y"), (1, "z")], "k LONG, v STRING")
    for number in (1, 2):
        upsert.upsert_batch(nulls, number, path, ["k"], [F.desc("v")])
    upsert.upsert_batch(keyed(spark, 0, 0, "a"), 3, path, ["k"], [F.desc("v")])
    assert sorted(map(tuple, upsert.read_upserted(spark, path).collect()), key=repr) == [(1, "z"), (None, "y"), (None, "y")]


def test_flow_over_an_empty_folder(spark, tmp_path):
    source_path, base = tmp_path / "in", str(tmp_path / "out")
    source_path.mkdir()
    read = refresh(spark, base, trips.flow(str(source_path), "s"))
    assert read("weekly_counts").count() == 0 and read("silver_trips").count() == 0


def test_trip_flow_reports_failed_expectations(spark, tmp_path):
    raw = spark.createDataFrame([tuple(str(i) for i in range(len(trips.RAW_COLUMNS)))] * 3, list(trips.RAW_COLUMNS))
    raw.write.option("header", True).csv(str(tmp_path / "in"))
    with runners.counted(spark) as totals:
        refresh(spark, str(tmp_path / "out"), trips.flow(str(tmp_path / "in"), "s", max_files=1))
        seen = totals.observed(trips.OBSERVED)
    assert seen["non_null_started_at"] == 3 and set(seen) == set(trips.EXPECTATIONS)


@pytest.mark.parametrize("limit", [{"max_files": 1}, {"max_bytes": 1}])
def test_a_backlog_is_read_in_parts(spark, tmp_path, limit):
    from tallyforge.sources import ingest

    spark.range(6).repartition(3).write.json(str(tmp_path / "in"))
    stream = ingest.stream_json(spark, str(tmp_path / "in"), "id LONG", **limit)
    with runners.counted(spark) as totals:
        total = totals.of(runners.finish(runners.append_to_files(stream, str(tmp_path / "d"), str(tmp_path / "c"))))
    assert total["triggers"] >= 3 and total["input_rows"] == 6
    with pytest.raises(ValueError):
        ingest.stream_json(spark, "x", "id LONG", max_files=1, max_bytes=1)


def test_replayed_batches_are_in_time_order(spark, tmp_path):
    path = str(tmp_path / "in")
    table = sales(spark, [50, 10, 40, 30, 20, 60, 70])
    assert replay.write_ordered_batches(table, path, "at", "id", batches=3) == 1
    assert replay.write_ordered_batches(table, str(tmp_path / "two"), "at", "id", batches=3, rows_per_file=1) == 2
    spans = [
        spark.read.parquet(f"{path}/batch={b}").agg(F.min("at"), F.max("at"), F.count("*")).first() for b in range(3)
    ]
    assert [s[2] for s in spans] == [2, 2, 3]
    assert spans[0][1] < spans[1][0] and spans[1][1] < spans[2][0]


def test_unknown_step_kind(spark, tmp_path):
    with pytest.raises(ValueError):
        refresh(spark, str(tmp_path), [Step("a", "other", lambda s, read: s.range(1))])


def test_trip_flow_takes_in_new_files_only(spark, tmp_path):
    source_path, base = tmp_path / "in", str(tmp_path / "out")
    source_path.mkdir()
    header = ",".join(trips.RAW_COLUMNS) + "\n"
    good = "{id},classic_bike,2024-01-01 10:00:00,2024-01-01 10:09:00,A,1,B,2,40.1,-73.9,40.2,-73.8,member\n"
    (source_path / "one.csv").write_text(header + good.format(id="r1") + "r2,x,soon,later,A,1,B,2,1,1,1,1,member\n")
    read = refresh(spark, base, trips.flow(str(source_path), "A"))
    assert read("bronze_trips").count() == 2 and read("silver_trips").count() == 1
    (source_path / "two.csv").write_text(header + good.format(id="r3"))
    read = refresh(spark, base, trips.flow(str(source_path), "A"))
    assert read("silver_trips").count() == 2
    row = read("station_connections").first()
    assert (row["other_station"], row["departure_count"], row["net_flow"], row["t_lat"]) == ("B", 2, 2, 40.1)


def test_order_flow(spark, tmp_path):
    (tmp_path / "orders").mkdir()
    (tmp_path / "orders" / "a.json").write_text(
        '{"order_id": "o1", "customer_id": 1, "product_id": "p", "quantity": 1, "amount": 10.5, "order_date": "2024-01-02 03:04:05"}\n'
        '{"order_id": "o2", "customer_id": 9, "product_id": "p", "quantity": 1, "amount": 1.0, "order_date": "2024-01-02 03:04:05"}\n'
    )
    (tmp_path / "customers.csv").write_text(
        "customer_id,name,email,region,signup_date\n1,Ann,a@x.org,north,2020-01-01\n2,,b@x.org,south,2020-01-01\n"
    )
    flow = orders.flow(str(tmp_path / "orders"), str(tmp_path / "customers.csv"))
    read = refresh(spark, str(tmp_path / "out"), flow)
    assert [(r["region"], r["order_count"], str(r["total_revenue"])) for r in read("daily_order_summary").collect()] == [
        ("north", 1, "10.50")
    ]


def test_post_flow(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        '{"date": "Mon Apr 06 22:19:45 PDT 2009", "user": "u", "text": "@Ann and @Zoë_1! fine", "sentiment": "4"}\n'
        '{"date": "broken", "user": "v", "text": "no one", "sentiment": "0"}\n'
    )

    def score(rows_in):
        label = F.when(F.col("text").contains("fine"), "POSITIVE").otherwise("NEGATIVE")
        return rows_in.withColumn("scored", F.struct(label.alias("label"), F.lit(0.75).alias("score")))

    read = refresh(spark, str(tmp_path / "out"), posts.flow(str(tmp_path / "in"), score))
    gold = read("posts_gold")
    assert gold.count() == 3
    assert {r["mention"] for r in gold.collect()} == {"@ann", "@zoë_1", None}
    lonely = gold.filter("mention IS NULL").first()
    assert (lonely["timestamp"], lonely["sentiment_id"], lonely["predicted_sentiment_id"], lonely["predicted_score"]) == (None, 0, 0, 75.0)
    assert gold.filter("mention = '@ann'").first()["timestamp"] == dt.datetime(2009, 4, 7, 5, 19, 45)
    assert {(r["mention"], r["total"]) for r in read("sentiment_by_mention").collect()} == {("@ann", 1), ("@zoë_1", 1)}
