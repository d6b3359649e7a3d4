"""Merge, update, delete, schema changes and de-duplication on generated tables."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyforge.operators import changes, dedup, expectations, joins

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.one_of(st.none(), st.integers(0, 6))
SCHEMA = "k INT, v INT"


@few
@given(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=25), st.dictionaries(st.integers(0, 9), st.integers(10, 19)),
       st.lists(st.integers(20, 29), max_size=2))
def test_merge_like_python(spark, target, source, keyless):
    given_rows = [(k, v) for k, v in source.items()] + [(None, v) for v in keyless]
    merged = changes.merge_into(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(given_rows, SCHEMA), ["k"]
    )
    present = {k for k, _ in target}
    twin = [(k, source.get(k, v) if k is not None else v) for k, v in target]
    twin += [(k, v) for k, v in source.items() if k not in present] + [(None, v) for v in keyless]
    assert sorted((tuple(r) for r in merged.collect()), key=repr) == sorted(twin, key=repr)


@few
@given(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=25), st.dictionaries(st.integers(0, 9), st.integers(10, 19)))
def test_merge_is_the_same_with_and_without_broadcast(spark, target, source):
    state = spark.createDataFrame(target, SCHEMA)
    given_rows = spark.createDataFrame(list(source.items()), SCHEMA)
    sent, shuffled = (
        sorted((tuple(r) for r in changes.merge_into(state, given_rows, ["k"], broadcast_rows=n).collect()), key=repr)
        for n in (100, 0)
    )
    assert sent == shuffled


def test_merge_is_idempotent(spark, rows):
    target = spark.createDataFrame([(1, 1), (2, 2)], SCHEMA)
    source = spark.createDataFrame([(2, 20), (3, 30)], SCHEMA)
    once = changes.merge_into(target, source, ["k"])
    assert rows(changes.merge_into(once, source, ["k"])) == rows(once) == [(1, 1), (2, 20), (3, 30)]


def test_merge_refuses_a_repeated_source_key(spark):
    target = spark.createDataFrame([(1, 1)], SCHEMA)
    source = spark.createDataFrame([(2, 20), (2, 21)], SCHEMA)
    with pytest.raises(PySparkException, match="repeats the key"):
        changes.merge_into(target, source, ["k"]).collect()


def test_merge_with_a_hot_target_key(spark):
    """One key holds most rows of the target: it is salted and every row is still updated."""
    target = spark.range(3000).select(F.when(F.col("id") < 2500, 0).otherwise(F.col("id")).cast("int").alias("k"),
                                      F.col("id").alias("v"))
    source = spark.createDataFrame([(0, -1), (2600, -2), (9999, -3)], "k INT, v LONG")
    merged = changes.merge_into(target, source, ["k"], spread_by=["v"], broadcast_rows=0)
    assert "_salt" in merged._jdf.queryExecution().toString()
    assert merged.count() == 3001
    assert merged.filter("v = -1").count() == 2500 and merged.filter("v < -1").count() == 2


def test_update_and_delete_leave_unknown_conditions_alone(spark, rows):
    table = spark.createDataFrame([(1, 1), (2, None), (3, 9)], SCHEMA)
    assert rows(changes.update_where(table, F.col("v") > 5, {"v": F.lit(0)})) == [(1, 1), (2, None), (3, 0)]
    assert rows(changes.delete_where(table, F.col("v") > 5)) == [(1, 1), (2, None)]


def test_append_needs_leave_to_evolve(spark, rows):
    table = spark.createDataFrame([(1, 1)], SCHEMA)
    wider = spark.createDataFrame([(2, 2, "x")], SCHEMA + ", extra STRING")
    with pytest.raises(ValueError, match="extra"):
        changes.append_rows(table, wider)
    assert rows(changes.append_rows(table, wider, evolve=True)) == [(1, 1, None), (2, 2, "x")]
    with pytest.raises(ValueError, match="does not fit"):
        changes.append_rows(table, spark.createDataFrame([(1, "a")], "k INT, v STRING"))


@few
@given(st.lists(st.tuples(st.sampled_from(["Ann", "ANN", "bob", "Bob", None]), st.integers(0, 3)), max_size=30))
def test_dedup_ignoring_case(spark, people):
    data = spark.createDataFrame([(i, n, g) for i, (n, g) in enumerate(people)], "i INT, name STRING, g INT")
    kept = dedup.keep_first_ignoring_case(data, ["name"], [F.col("i")], ["g"])
    first = {}
    for i, (n, g) in enumerate(people):
        first.setdefault((n and n.lower(), g), i)
    assert sorted(r["i"] for r in kept.collect()) == sorted(first.values())


def test_dedup_on_digits(spark):
    data = spark.createDataFrame(
        [(1, "Ann", "555-1"), (2, "ANN", "(555) 1"), (3, "Ann", "5552")], "i INT, name STRING, phone STRING"
    )
    kept = dedup.keep_first_standardised(data, ["name"], ["phone"], [F.col("i")])
    assert sorted(r["i"] for r in kept.collect()) == [1, 3] and kept.columns == data.columns


def test_noisy_copies_fold_back(spark):
    base = spark.createDataFrame([(i, f"Name{i}", f"m{i}@x.org") for i in range(20)], "i INT, name STRING, email STRING")
    noisy = dedup.with_noisy_copies(base, 12, {"name": 3, "email": 4})
    assert noisy.count() == 240
    assert dedup.keep_first_ignoring_case(noisy, ["name", "email"], [F.col("duplicate_id")]).count() == 20


def test_noisy_copies_are_spread_by_their_number(spark):
    """No task gets more copies than the bound, however few partitions are asked for; they stay as asked for where that is enough."""
    people = spark.range(6_000).select("id", F.concat(F.lit("n"), "id").alias("name"))
    noisy = dedup.with_noisy_copies(people, 350, {"name": 3}, 2)
    sizes = [r["count"] for r in noisy.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6_000 * 350 and max(sizes) <= 1.1 * dedup.COPIES_PER_TASK
    assert dedup.with_noisy_copies(people, 2, {}, 3).rdd.getNumPartitions() == 3


RULES = {"positive": "v > 0", "small": "v < 8"}


@few
@given(st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(-5, 12))), max_size=30))
def test_expectations(spark, data):
    table = spark.createDataFrame(data, SCHEMA)
    good = [r for r in data if r[1] is not None and 0 < r[1] < 8]
    assert sorted((tuple(r) for r in expectations.keep_expected(table, RULES).collect()), key=repr) == sorted(good, key=repr)
    failed = {r["rule"]: r["failures"] for r in expectations.count_failures(table, RULES).collect()}
    assert failed == {
        "positive": sum(v is None or v <= 0 for _, v in data), "small": sum(v is None or v >= 8 for _, v in data)
    }


def test_without_match_ignores_missing_keys_on_the_right(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a INT")
    right = spark.createDataFrame([(2,), (2,), (None,)], "b INT")
    assert rows(joins.without_match(left, right, "a", "b")) == [(1,), (None,)]
    many = spark.range(2000).select("id", F.when(F.col("id") > 9, 10).otherwise(F.col("id")).alias("a"))
    some = spark.createDataFrame([(3,), (11,)], "b LONG")
    assert joins.without_match(many, some, "a", "b", spread_by=["id"]).count() == 1999


def test_merge_counts_fills_zero(spark, rows):
    left = spark.createDataFrame([("a", 1)], "k STRING, x LONG")
    right = spark.createDataFrame([("b", 2)], "k STRING, y LONG")
    assert rows(joins.merge_counts(left, right, ["k"], ["x", "y"])) == [("a", 1, 0), ("b", 0, 2)]


def scans(df):
    return str(df._jdf.queryExecution().optimizedPlan()).count("Relation")


@pytest.mark.parametrize("small, hot", [(True, None), (False, {}), (False, None), (None, None)])
def test_merge_is_the_same_in_each_way(spark, rows, tmp_path, small, hot):
    target = spark.createDataFrame([(i % 50 if i % 10 else None, i, "old") for i in range(400)], "k INT, n INT, v STRING")
    target.write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.createDataFrame([(k, -k, "new") for k in range(0, 100, 3)] + [(None, 7, "new"), (None, 8, "new")], "k INT, n INT, v STRING")
    found = changes.merge_into(target, source, ["k"], update=["v"], small=small, hot=hot)
    given = set(range(0, 100, 3))
    want = [(r.k, r.n, "new" if r.k in given else r.v) for r in target.collect()]
    held = {r.k for r in target.collect()}
    want += [(k, -k, "new") for k in given - held] + [(None, 7, "new"), (None, 8, "new")]
    assert rows(found) == sorted(want, key=repr)
    if hot == {}:
        assert scans(found) == 1  # of the target


def test_merge_at_once_refuses_a_repeated_key(spark):
    target = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k INT, v STRING")
    with pytest.raises(Exception, match="repeats the key"):
        changes.merge_into(target, twice, ["k"], small=False, hot={}).collect()
