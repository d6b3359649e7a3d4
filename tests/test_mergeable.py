"""Partial aggregates: merged from parts they give what all rows give; views take in new rows only."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import aggregates, mergeable
from tallyforge.sources.ingest import stream_parquet
from tallyforge.streaming import runners, views

MEASURES = {
    "sum": mergeable.total("v"), "n": mergeable.row_count(), "known": mergeable.known_count("v"), "low": mergeable.smallest("v"),
    "high": mergeable.largest("v"), "ids": mergeable.distinct("id"), "parts": mergeable.quantiles("v", [0.1, 0.5, 0.9]),
}


def values(spark, count, seed=1):
    rng = random.Random(seed)
    rows = [(i % 3, i % 7, rng.randrange(count), rng.choice([None, *(float(x) for x in range(50))])) for i in range(count)]
    return spark.createDataFrame(rows, "k INT, day INT, id LONG, v DOUBLE")


def test_merged_parts_equal_one_pass(spark, rows):
    data = values(spark, 6_000)
    exact = ["k", "sum", "n", "known", "low", "high"]
    once = mergeable.finished(mergeable.partials(data, ["k"], MEASURES), MEASURES)
    daily = mergeable.partials(data, ["k", "day"], MEASURES)
    twice = mergeable.finished(mergeable.merged(mergeable.merged(daily, ["k", "day"], MEASURES), ["k"], MEASURES), MEASURES)
    assert rows(once.select(exact)) == rows(twice.select(exact))
    truth = {r.k: r.n for r in data.groupBy("k").agg(F.count_distinct("id").alias("n")).collect()}
    for r in twice.collect():
        assert abs(r.ids - truth[r.k]) <= 3 * mergeable.DISTINCT_ERROR * truth[r.k]


def test_merged_quantiles_keep_their_bound(spark):
    """Sketches of many small parts, merged; each value lies within the error of its rank."""
    data = values(spark, 30_000, 2).where("v is not null").withColumn("v", F.col("v") + F.col("id") / 1e6)
    measure = {"q": mergeable.quantiles("v", [0.01, 0.25, 0.5, 0.75, 0.99])}
    parts = mergeable.partials(data, ["k", F.pmod("id", F.lit(40)).alias("part")], measure)
    for r in mergeable.finished(mergeable.merged(parts, ["k"], measure), measure).collect():
        mine = sorted(x.v for x in data.where(F.col("k") == r.k).select("v").collect())
        for point, value in zip([0.01, 0.25, 0.5, 0.75, 0.99], r.q):
            below, up_to = sum(x < value for x in mine) / len(mine), sum(x <= value for x in mine) / len(mine)
            assert below - mergeable.RANK_ERROR <= point <= up_to + mergeable.RANK_ERROR


def test_groups_without_values(spark):
    data = spark.createDataFrame([(1, None, None), (1, None, None)], "k INT, id LONG, v DOUBLE")
    parts = mergeable.partials(data, ["k"], MEASURES)
    found = mergeable.finished(mergeable.merged(parts.unionByName(parts), ["k"], MEASURES), MEASURES).first()
    assert (found["sum"], found.n, found.known, found.low, found.ids, found.parts) == (None, 4, 0, None, 0, None)
    empty = mergeable.finished(mergeable.merged(parts.limit(0), ["k"], MEASURES), MEASURES)
    assert empty.collect() == []


def sales(spark):
    rng = random.Random(3)
    days = [None, *(datetime.date(2023, 1, 1) + datetime.timedelta(days=17 * i) for i in range(60))]
    rows = [(rng.choice(days), rng.choice([None, 1.5, 2.0, 10.0]), rng.choice([None, -5, 0, 7, 40_000, 32_768, 10**12, *range(20)])) for _ in range(2_000)]
    return spark.createDataFrame(rows, "d DATE, amount DOUBLE, who LONG")


def test_rollup_by_bitmaps_equals_rollup_of_rows(spark, rows):
    data = sales(spark)
    level = F.grouping_id()
    want = (
        data.select(F.year("d").alias("year"), F.quarter("d").alias("quarter"), F.month("d").alias("month"), "amount", "who")
        .rollup("year", "quarter", "month")
        .agg(
            F.sum("amount").alias("total_sales"), F.count("*").alias("transaction_count"), F.count_distinct("who").alias("unique_customers"),
            F.avg("amount").alias("avg_transaction_amount"),
            F.when(level == 7, "Grand Total").when(level == 3, "Year Total").when(level == 1, "Quarter Total").otherwise("Month Detail").alias("aggregation_level"),
        )
    )
    assert rows(aggregates.calendar_rollup(data, "d", "amount", "who").select(want.columns)) == rows(want)


def test_stored_cells_of_two_periods_merge(spark, rows):
    data = sales(spark)
    cells = [aggregates.calendar_cells(data.where(part), "d", "amount", "who") for part in ("d < '2024-02-10'", "d >= '2024-02-10' or d is null")]
    both = aggregates.rolled_up(cells[0].unionByName(cells[1]))
    assert rows(both) == rows(aggregates.calendar_rollup(data, "d", "amount", "who").select(both.columns))


def test_rollup_copies_no_rows(spark):
    plan = aggregates.calendar_cells(sales(spark), "d", "amount", "who")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_rollup_of_an_empty_table(spark):
    assert aggregates.calendar_rollup(sales(spark).limit(0), "d", "amount", "who").collect() == []


def refreshed(spark, tmp_path, name="refresh", checkpoint="c"):
    stream = stream_parquet(spark, str(tmp_path / "in"), values(spark, 1).schema)
    with runners.counted(spark) as totals:
        query = views.refresh_view(stream, str(tmp_path / "view"), str(tmp_path / checkpoint), ["k"], MEASURES, name, bucket_rows=2)
        return totals.of(runners.finish(query))["input_rows"]


EXACT = ["k", "sum", "n", "known", "low", "high"]


def test_second_refresh_reads_new_files_only(spark, rows, tmp_path):
    parts = [values(spark, 900, 4), values(spark, 700, 5), values(spark, 10, 6).withColumn("k", F.lit(None).cast("int"))]
    data = None
    for part in parts:
        part.write.mode("append").parquet(str(tmp_path / "in"))
        assert refreshed(spark, tmp_path) == part.count()
        data = part if data is None else data.unionByName(part)
        whole = mergeable.finished(mergeable.partials(data, ["k"], MEASURES), MEASURES)
        seen = views.read_view(spark, str(tmp_path / "view"), MEASURES)
        assert rows(seen.select(EXACT)) == rows(whole.select(EXACT))
        truth = {r.k: r.n for r in data.groupBy("k").agg(F.count_distinct("id").alias("n")).collect()}
        assert all(abs(r.ids - truth[r.k]) <= 3 * mergeable.DISTINCT_ERROR * truth[r.k] for r in seen.collect())
    assert refreshed(spark, tmp_path) == 0
    everything = views.read_view(spark, str(tmp_path / "view"), {"n": MEASURES["n"]}, keys=[])
    assert everything.first().n == 1_610


def test_view_outlives_its_checkpoint(spark, rows, tmp_path):
    first, second = values(spark, 500, 7), values(spark, 400, 8)
    first.write.parquet(str(tmp_path / "in"))
    refreshed(spark, tmp_path)
    (tmp_path / "in").rename(tmp_path / "read")
    second.write.parquet(str(tmp_path / "in"))
    assert refreshed(spark, tmp_path, "again", "c2") == 400
    whole = mergeable.finished(mergeable.partials(first.unionByName(second), ["k"], MEASURES), MEASURES)
    assert rows(views.read_view(spark, str(tmp_path / "view"), MEASURES).select(EXACT)) == rows(whole.select(EXACT))


def test_a_repeated_batch_counts_once(spark, rows, tmp_path):
    path = str(tmp_path / "view")
    first, second = values(spark, 300, 9), values(spark, 200, 10)
    for number, part in ((0, first), (1, second), (1, second)):
        views.merge_rows(part, "r", number, path, ["k"], MEASURES)
    whole = mergeable.finished(mergeable.partials(first.unionByName(second), ["k"], MEASURES), MEASURES)
    assert rows(views.read_view(spark, path, MEASURES).select(EXACT)) == rows(whole.select(EXACT))


@pytest.mark.parametrize("points", [{"a": 0.0, "b": 1.0}, {"m": 0.5, "x": 0.55}])
def test_weighted_quantiles(spark, points):
    from tallyforge.operators.scans import weighted_quantiles

    rng = random.Random(11)
    data = [(rng.choice(["a", "a", "a", "a", "b", None]), rng.choice([None, *range(30)]), rng.choice([None, 0, 1, 2, 50])) for _ in range(500)]
    found = weighted_quantiles(spark.createDataFrame(data, "g STRING, v INT, w INT"), ["g"], "v", "w", **points)
    for r in found.collect():
        mine = sorted(v for g, v, w in data if g == r.g and v is not None and w for _ in range(w))
        for name, p in points.items():
            assert r[name] == mine[max(1, -int(-round(p * len(mine), 6) // 1)) - 1]
    with pytest.raises(ValueError):
        weighted_quantiles(spark.createDataFrame(data, "g STRING, v INT, w INT"), [], "v", "w", m=0.5)
