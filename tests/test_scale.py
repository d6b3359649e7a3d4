"""Plans and skew: what is pushed down, what is split, what never meets in one task."""

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import evaluation, layout, models, numbering, quality, skew, totals, windows
from tallyforge.plans import customers as cust, franchises, trips
from tallyforge.session import scratch, shared_dir, stored
from tallyforge.workload import load_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(load_queries()["src03_parquet_pushdown"].build(tables))
    assert "FileScan parquet [l_orderkey" in text and "l_partkey" not in text and "l_shipdate" not in text
    assert "DataFilters: [isnotnull(l_quantity" in text and "PushedFilters: [" in text


def test_stacked_filters_become_one(tables):
    text = plan(load_queries()["prj11_filters"].build(tables))
    assert text.count("Filter ") == 1


def test_top_k_does_not_sort_everything(tables):
    assert "TakeOrderedAndProject" in plan(load_queries()["st02_top_k"].build(tables))


@pytest.mark.parametrize("name", ["prj17_dedup", "prj18_dedup_ignoring_case", "wn01_top_per_group"])
def test_group_limits_apply_before_the_shuffle(tables, name):
    assert "WindowGroupLimit" in plan(load_queries()[name].build(tables))


# Queries whose SQL feature is Python code; no other may start Python workers.
PYTHON = {"ud05_from_sql", "ud18_python_equals_builtin", "pt02_partition_sizes"}
# Streams and models run while they are built.
EAGER = ("sm", "snk0", "ml", "ud19", "src1", "mu06", "mu08", "mu09", "pt04")


def test_no_python_per_row_and_no_cartesian_product(tables):
    for name, query in load_queries().items():
        if name in PYTHON or name.startswith(EAGER):
            continue
        text = plan(query.build(tables))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


@pytest.mark.parametrize(
    "name", ["wn02_percent_rank", "wn10_ordered_batches", "wn11_row_numbers", "wn12_ranked_customers", "pl05_sensor_health"]
)
def test_no_window_without_partition(tables, name):
    """A window over everything would pull all rows into one partition first."""
    text = plan(load_queries()[name].build(tables))
    assert "SinglePartition" not in text


def test_hot_keys_are_found_and_split(spark, rows):
    left = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    right = left.groupBy("k").agg(F.count("*").alias("n"))
    found = skew.hot_keys(left, ["k"], partitions=90)
    assert list(found.values()) == [30]
    salted = skew.salted_join(left, right, ["k"], ["id"], hot=found)
    assert rows(salted.select("id", "n")) == rows(left.join(right, "k").select("id", "n"))
    assert "_salt" in plan(salted)


def test_every_key_larger_than_two_partitions_is_split(spark):
    small = spark.range(100_000).select(F.when(F.col("id") < 900, -1).otherwise(F.col("id")).alias("k"))
    assert list(skew.hot_keys(small, ["k"], partitions=400).values()) == [4]  # a key of 0.9 %
    half = spark.range(100_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert list(skew.hot_keys(half, ["k"], partitions=400).values()) == [200]
    equal = spark.range(120_000).select((F.col("id") % 120).alias("k"))
    assert len(skew.hot_keys(equal, ["k"], partitions=400)) == 120
    assert skew.hot_keys(spark.range(0), ["id"]) == {} == skew.hot_keys(spark.range(5), ["id"], partitions=400)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_salting_keeps_other_join_kinds(spark, rows, how):
    left = spark.range(3000).select("id", (F.col("id") % 2 * F.col("id")).alias("k"))
    right = spark.range(0, 3000, 3).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    assert rows(skew.salted_join(left, right, ["k"], ["id"], how)) == rows(left.join(right, ["k"], how).select(
        *skew.salted_join(left, right, ["k"], ["id"], how).columns))


def test_salting_refuses_right_outer(spark):
    with pytest.raises(ValueError):
        skew.salted_join(spark.range(3), spark.range(3), ["id"], ["id"], "right")


def test_broadcast_is_checked(spark):
    small, large = spark.range(10), spark.range(10_000)
    assert skew.broadcast_if_small(small, 100) is not small
    assert skew.broadcast_if_small(large, 100) is large
    wide = spark.range(50).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert skew.broadcast_if_small(wide, 100, max_bytes=1000) is wide


def test_totals_must_be_one_row(spark):
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        totals.with_totals(spark.range(3), spark.range(2).select(F.col("id").alias("x"))).collect()


def test_row_numbers_over_one_repeated_value(spark):
    """All rows tie on the first sort column; the second one still spreads them."""
    data = spark.range(5000).select("id", F.lit(7).alias("same"))
    numbered = numbering.number_rows(data, F.col("same"), F.desc("id"), name="n")
    assert numbered.filter(F.col("n") != 5000 - F.col("id")).count() == 0


def test_percent_rank_with_ties_and_missing_values(spark):
    data = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 5.0), (4, None), (5, 20.0)], "i INT, v DOUBLE")
    got = {r["i"]: r["percent_rank"] for r in numbering.percent_rank(data, "v").collect()}
    assert got == {5: 0.0, 1: 0.25, 2: 0.25, 3: 0.75, 4: 1.0}
    single = spark.createDataFrame([(1, 1.0)], "i INT, v DOUBLE")
    assert numbering.percent_rank(single, "v").first()["percent_rank"] == 0.0


def test_batches_take_the_remainder_last(spark):
    cut = numbering.ordered_batches(spark.range(13), 5, F.col("id"))
    assert [r["count"] for r in cut.groupBy("batch_id").count().orderBy("batch_id").collect()] == [2, 2, 2, 2, 5]


def test_shared_folders_follow_the_session(spark):
    assert stored(spark.range(3), "three").count() == 3
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second and (base is None or first.startswith(base))


def test_deviation_labels_keep_missing_groups(spark, rows):
    data = spark.createDataFrame([(None, float(i)) for i in range(3)] + [("a", 1.0)], "g STRING, v DOUBLE")
    assert windows.label_deviation(data, ["g"], "v").count() == 4


def test_partition_tools(spark):
    spread = spark.range(100).repartition(4)
    assert sorted(r["row_count"] for r in layout.partition_sizes(spread).collect()) == [25] * 4
    assert layout.partition_sample(spread, 3).groupBy("partition").count().filter("count <> 3").isEmpty()
    assert spread.coalesce(2).rdd.getNumPartitions() == 2
    buckets = layout.bucket_of(spark.range(1000), 10, "id").groupBy("bucket").count()
    assert buckets.agg(F.sum("count")).first()[0] == 1000 and buckets.filter("bucket < 0").isEmpty()
    same = layout.by_key(spark.range(100).select((F.col("id") % 5).alias("k")), 4, "k")
    assert same.select("k", F.spark_partition_id().alias("p")).distinct().count() == 5


def test_kept_is_released_on_error(spark):
    with pytest.raises(RuntimeError):
        with layout.kept(spark.range(10)) as held:
            assert held.count() == 10 and held.is_cached
            raise RuntimeError
    assert not held.is_cached


def test_previews_stay_bounded(spark):
    assert len(spark.range(10**9).take(3)) == 3
    assert spark.range(10**9).limit(5).count() == 5


def test_sampling_is_binomial(tables):
    found = load_queries()["prj20_sample"].build(tables).first()
    assert found["row_count"] == tables.lineitem.count() and found["size_as_expected"] and found["foreign_rows"] == 0


def test_approximate_distinct_is_close(tables):
    days = load_queries()["ag05_approx_distinct"].build(tables).collect()
    exact = tables.sales.groupBy(F.date_format("sold_at", "yyyy-MM-dd").alias("d")).agg(F.count_distinct("customer_id").alias("n"))
    assert {r["transaction_date"]: r["active_customers"] for r in days} == {r["d"]: r["n"] for r in exact.collect()}
    assert all(r["close"] for r in days)


def test_split_is_stable_and_whole(tables):
    train, test = models.split_by_key(tables.orders, "o_orderkey")
    assert train.count() + test.count() == tables.orders.count()
    assert train.join(test, "o_orderkey").isEmpty()
    assert 0.15 < test.count() / tables.orders.count() < 0.25


def test_forests_are_ranked_by_error(spark):
    data = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"), F.lit(1.0).alias("noise")).withColumn("y", F.col("x") * 3)
    ranked = models.compare_forests(data, "y", ["id"], {"blind": (("noise",), 3, 2), "seeing": (("x",), 5, 5)}).collect()
    assert [r["feature_set"] for r in ranked] == ["seeing", "blind"]
    assert ranked[0]["r2"] > 0.9 > ranked[1]["r2"]


def test_trees_are_grown_on_cells_that_stand_for_all_rows(spark, monkeypatch):
    """Twenty times the rows give hardly more cells, with all rows and the whole sum of labels in them."""
    grown, features = [], ["x", "hour"]
    fit = models.RandomForestRegressor.fit
    monkeypatch.setattr(models.RandomForestRegressor, "fit", lambda self, cells, *more: grown.append(cells) or fit(self, cells, *more))
    for n in (20_000, 400_000):
        data = spark.range(n).select(
            F.rand(1).alias("x"), (F.col("id") % 24).alias("hour"), (F.col("id") % 7).cast("double").alias("noise")
        ).withColumn("y", 10 * F.col("x") + F.col("hour") + F.col("noise"))
        model = models.fit_forest(data, features, "y", 5, 8)
        error = model.transform(data).agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
        assert 1.9 < error < 2.5  # that of the noise is 2
        total = grown[-1].agg(F.sum("_weight"), F.sum(F.col("_weight") * F.col("y"))).first()
        assert total[0] == n and total[1] == pytest.approx(data.agg(F.sum("y")).first()[0])
        assert grown[-1].count() <= 32 * 24 * models.CELL_PARTS


def test_text_classifier_learns_a_word(spark):
    data = spark.range(200).select(
        "id", F.when(F.col("id") % 2 == 0, "what a fine day").otherwise("what a grey day").alias("t"), ((F.col("id") + 1) % 2).cast("int").alias("y")
    )
    scored = models.score_sentiment(models.fit_text_classifier(data, "t", "y"), data)
    assert scored.filter((F.col("scored.label") == "POSITIVE") != (F.col("y") == 1)).isEmpty()
    assert scored.filter("scored.score < 0.5 OR scored.score > 1").isEmpty()


def test_schema_differences_and_uncastable_values(spark):
    from pyspark.sql import types as T

    data = spark.createDataFrame([("1", "x"), ("b", None)], "id STRING, extra STRING")
    wanted = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("gone", T.StringType())])
    assert quality.schema_differences(data, wanted) == [
        "Missing column: gone", "Extra column: extra", "Type mismatch for id: expected int, got string"
    ]
    assert [tuple(r) for r in quality.uncastable_values(data, wanted).collect()] == [("id", 1)]


def test_fill_strategies(spark, rows):
    data = spark.createDataFrame([(1, None), (None, "a")], "n INT, s STRING")
    assert rows(quality.fill_missing(data, "drop")) == []
    assert rows(quality.fill_missing(data, "zero")) == [(0, "a"), (1, None)]
    assert rows(quality.fill_missing(data, "text")) == [(1, "Unknown"), (None, "a")]


def test_classification_report_reproduces_published_figures(spark):
    """The four cells behind a published report of 43,657 rows give its figures."""
    cells = [(0, 0, 17287), (0, 1, 4420), (1, 0, 8052), (1, 1, 13898)]
    data = spark.createDataFrame(cells, "t INT, p INT, n INT").select("t", "p", F.explode(F.sequence(F.lit(1), "n")))
    report = {r["label"]: r for r in evaluation.classification_report(data, "t", "p", ["Negative", "Positive"]).collect()}
    assert report["Negative"]["precision"] == pytest.approx(0.68223, abs=1e-5)
    assert report["Negative"]["recall"] == pytest.approx(0.79638, abs=1e-5)
    assert report["Positive"]["f1_score"] == pytest.approx(0.69028, abs=1e-5)
    assert report["accuracy"]["f1_score"] == pytest.approx(0.714318, abs=1e-6)
    assert report["macro avg"]["f1_score"] == pytest.approx(0.712586, abs=1e-6)
    assert report["weighted avg"]["f1_score"] == pytest.approx(0.712462, abs=1e-6)
    assert report["weighted avg"]["support"] == 43657


def test_reports_agree_in_two_forms(tables, rows):
    joined = tables.transactions.join(tables.customers, "customer_id").groupBy("state", "category").agg(
        F.round(F.sum("amount"), 2), F.count("*")
    )
    early = cust.sales_by_state_and_category(tables.transactions, tables.customers)
    assert rows(joined) == rows(early.withColumn("total_amount", F.round("total_amount", 2)))


def test_segment_analysis_without_join(tables):
    light = cust.largest_totals(cust.category_totals(tables.transactions, 50), "total")
    assert light.columns == ["category", "total", "count"] and "Join" not in plan(light)


def test_percent_rank_keeps_rows_whose_value_changes(spark):
    """The value is another one each time the plan is evaluated, as sums of doubles can be."""
    data = spark.range(500).select("id", F.rand().alias("v"))
    assert numbering.percent_rank(data, "v").count() == 500


@pytest.mark.parametrize("name, table", [("pl02_lifetime_value", "orders"), ("pl22_counters", "documents"), ("pl22b_top_lists", "documents")])
def test_fact_tables_are_scanned_once(tables, name, table):
    text = plan(load_queries()[name].build(tables))
    assert text.count(f"{table}.parquet") <= 1, text


def test_executive_report_runs_on_empty_sales(tables):
    assert franchises.executive_report(tables.sales.limit(0), tables.franchises).count() == 0


def test_trip_counts_of_a_round_trip(spark):
    raw = spark.createDataFrame(
        [("r", "c", "2024-01-01 10:00:00", "2024-01-01 10:05:00", "A", "1", "A", "1", "1", "2", "3", "4", "m")],
        ", ".join(f"{c} STRING" for c in trips.RAW_COLUMNS),
    )
    row = trips.station_connections(trips.clean_trips(raw), "A").first()
    assert (row["other_station"], row["departure_count"], row["arrival_count"], row["lat"], row["t_lat"]) == ("A", 1, 1, 3.0, 1.0)


def test_scratch_removes_what_is_stored_in_it(spark, tmp_path):
    import os

    with scratch(spark) as folder:
        kept = stored(spark.range(3), "three")
        assert kept.count() == 3 and os.path.isdir(folder) and kept.inputFiles()[0].startswith(f"file://{folder}")
        with scratch(spark) as inner:
            assert shared_dir(spark, "x").startswith(inner)
        assert shared_dir(spark, "x").startswith(folder)
    assert not os.path.exists(folder) and not shared_dir(spark, "x").startswith(folder)
