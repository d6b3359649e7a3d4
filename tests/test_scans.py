"""Running and moving figures over slices and chunks, pages, and layouts on several columns."""

import random

import pytest
from pyspark.sql import Window, functions as F

from tallyforge.operators import aggregates, scans, skew, windows
from tallyforge.session import stored
from tallyforge.sources import states


def lopsided(spark, count=4_000):
    """Half of all rows have one key."""
    rng = random.Random(1)
    rows = [(i, 0 if i % 2 else rng.choice([None, *range(1, 40)]), rng.randrange(10**6), rng.choice([None, 1, 5, -3])) for i in range(count)]
    return spark.createDataFrame(rows, "id LONG, k INT, at LONG, v LONG")


@pytest.fixture
def many_slices(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_running_equals_a_window(spark, rows, many_slices):
    data, order = lopsided(spark), [F.col("at"), F.col("id")]
    w = Window.partitionBy("k").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = data.withColumns({"total": F.sum("v").over(w), "seen": F.count("*").over(w)})
    assert rows(scans.running(data, ["k"], order, total=F.col("v"), seen=F.lit(1))) == rows(want)


def test_a_hot_key_lies_in_many_slices(spark, many_slices):
    """No slice holds much more than its share of the rows, though one key has half of them."""
    laid = scans.sorted_slices(lopsided(spark), [F.col("k"), F.col("at"), F.col("id")])
    sizes = {r["_slice"]: r["count"] for r in laid.groupBy("_slice").count().collect()}
    hot = laid.where("k = 0").select("_slice").distinct().count()
    assert max(sizes.values()) <= 2.5 * 4_000 / 20 and hot >= 8


@pytest.mark.parametrize("chunk_rows", [1, 3, 50, 10**6])
def test_frames_over_chunks_equal_windows(spark, rows, many_slices, chunk_rows):
    data, order = lopsided(spark, 600), [F.desc("at"), F.col("id")]
    w = Window.partitionBy("k").orderBy(*order)
    figures = {
        "before": lambda w: F.lag("id", 2).over(w), "after": lambda w: F.lead("id").over(w),
        "mean": lambda w: F.avg("v").over(w.rowsBetween(-2, 1)), "first": lambda w: F.first("id").over(w.rowsBetween(-1, 0)),
    }
    want = data.withColumns({n: f(w) for n, f in figures.items()})
    assert rows(scans.framed(data, ["k"], order, back=2, ahead=1, chunk_rows=chunk_rows, **figures)) == rows(want)


def test_frames_bound_the_rows_of_a_task(spark, many_slices):
    data = lopsided(spark, 2_000)
    placed = scans.positions(data, ["k"], [F.col("at"), F.col("id")])
    seen = scans.framed(placed, ["k"], [F.col("at")], back=1, chunk_rows=100, position="position", n=lambda w: F.count("*").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    assert seen.agg(F.max("n")).first()[0] <= 101
    with pytest.raises(ValueError):
        scans.framed(data, ["k"], [F.col("at")], chunk_rows=0)


def test_empty_tables(spark):
    data, order = lopsided(spark, 10).limit(0), [F.col("id")]
    assert scans.running(data, ["k"], order, n=F.lit(1)).collect() == []
    assert scans.framed(data, ["k"], order, back=1, p=lambda w: F.lag("id").over(w)).collect() == []
    assert scans.weighted_quantiles(data, ["k"], "v", "id", m=0.5).collect() == []
    assert aggregates.collect_pages(data, ["k"], "v", "vs").collect() == []


def test_pages_of_a_key_with_very_many_values(spark, many_slices):
    many = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") * 7 % 150_000).alias("v"))
    few = spark.createDataFrame([("cold", 3), ("cold", 1), ("cold", None), (None, 5), ("none", None)], "k STRING, v LONG")
    pages = aggregates.collect_pages(many.unionByName(few), ["k"], "v", "vs", page_size=1_000).collect()
    hot = sorted((r for r in pages if r.k == "hot"), key=lambda r: r.page)
    assert [r.page for r in hot] == list(range(150)) and all(len(r.vs) == 1_000 for r in hot)
    assert [v for r in hot for v in r.vs] == list(range(150_000))
    assert {(r.k, r.page): r.vs for r in pages if r.k != "hot"} == {("cold", 0): [1, 3], (None, 0): [5]}


def test_deviation_of_a_large_group_is_spread(spark, rows):
    data = lopsided(spark).where("v is not null")
    w = Window.partitionBy("k")
    far = F.abs(F.col("v") - F.avg("v").over(w))
    sd = F.stddev("v").over(w)
    want = data.withColumn("health_status", F.when(far > 2 * sd, "ANOMALY").when(far > sd, "WARNING").otherwise("NORMAL"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = skew.hot_keys(data, ["k"])
        assert hot
        found = windows.label_deviation(data, ["k"], "v", hot=hot)
        assert "_salt" in found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == rows(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def files_read(spark, path, condition):
    """Files with a row group whose statistics don't rule the condition out, as the reader would skip the others."""
    import pyarrow.parquet as pq

    column, low, high = condition
    names = [f.replace("file://", "") for f in spark.read.parquet(path).inputFiles()]
    hits = 0
    for name in names:
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        hits += any(s.has_min_max and s.min <= high and s.max >= low for s in stats)
    return hits, len(names)


def test_filters_on_either_column_skip_files(spark, rows, tmp_path):
    rng = random.Random(2)
    data = stored(spark.createDataFrame([(i, rng.randrange(1000), rng.random(), f"t{rng.randrange(500):03d}") for i in range(8_000)], "id LONG, a LONG, b DOUBLE, c STRING"), "points")
    both, one = str(tmp_path / "both"), str(tmp_path / "one")
    states.clustered_by_all(data, ["a", "b"], 64).write.parquet(both)
    states.clustered(data, "a", 64).write.parquet(one)
    assert rows(spark.read.parquet(both)) == rows(data)
    second = ("b", 0.4, 0.45)
    found, of = files_read(spark, both, second)
    assert of >= 32 and found <= of / 2
    assert files_read(spark, both, ("a", 400, 450))[0] <= of / 2
    assert files_read(spark, one, second)[0] > 0.9 * files_read(spark, one, second)[1]


def test_clustering_takes_texts_dates_and_nulls(spark, rows):
    data = spark.createDataFrame([(None, None, None), ("b", None, 1), ("a", None, 2), ("éa", None, None)] * 5, "t STRING, d DATE, n INT")
    data = data.withColumn("d", F.when(F.col("n") == 1, F.lit("2024-01-01").cast("date")))
    assert rows(states.clustered_by_all(data, ["t", "d", "n"], 4)) == rows(data)
    assert states.clustered_by_all(data.limit(0), ["t", "n"], 4).collect() == []


def test_places_on_the_curve(spark):
    places = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a LONG, b LONG").withColumn("p", states.curve_place([F.col("a"), F.col("b")], 2))
    assert {(r.a, r.b): r.p for r in places.collect()} == {
        (a, b): ((a >> 1) << 3) | ((b >> 1) << 2) | ((a & 1) << 1) | (b & 1) for a in range(4) for b in range(4)
    }
