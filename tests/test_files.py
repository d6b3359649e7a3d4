"""Sources and sinks on files in a fresh folder."""

import datetime
import json

import pytest
from pyspark.sql import functions as F, types as T

from tallyforge.sources import databases, files, ingest, sinks, states
from tallyforge.streaming.runners import append_to_files, finish

SCHEMA = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())]
)
DATA = [(1, "Ann", 1.5), (2, None, -2.0), (3, "Zoë, the \"best\"", None)]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(DATA, SCHEMA)


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_round_trip(spark, table, rows, tmp_path, fmt):
    path = str(tmp_path / fmt)
    sinks.write_files(table, path, fmt)
    read = {"csv": files.read_csv, "json": files.read_json}.get(fmt)
    back = read(spark, path, SCHEMA) if read else spark.read.format(fmt).load(path)
    assert rows(back.select("id", "name", "x")) == rows(table)
    assert back.schema["x"].dataType == T.DoubleType()


def test_csv_inference(spark, table, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_files(table, path, "csv")
    assert dict(files.read_csv(spark, path).dtypes) == {"id": "int", "name": "string", "x": "double"}


def test_in_memory_sources(spark):
    assert spark.range(0, 10, numPartitions=3).count() == 10
    assert spark.createDataFrame(DATA, ["id", "name", "x"]).count() == 3


def test_rescued_line_is_kept_whole(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,name,x\n1,Ann,1.5\n2,Bob,2.5,extra,fields\nx,Cid,3.5\n")
    back = {r["name"]: r for r in files.read_csv_rescued(spark, str(tmp_path), SCHEMA).collect()}
    assert back["Ann"][files.RESCUED] is None
    assert back["Bob"][files.RESCUED] == "2,Bob,2.5,extra,fields"
    assert back["Cid"]["id"] is None and back["Cid"][files.RESCUED] == "x,Cid,3.5"


def test_lines_and_fields(spark, tmp_path):
    (tmp_path / "in.txt").write_text('id,name\n1,"a,b"\nbroken,c\n')
    lines = files.read_lines(spark, str(tmp_path / "in.txt"), header="id,name")
    assert [tuple(r) for r in files.split_fields(lines, "id INT, name STRING").orderBy("name").collect()] == [
        (1, "a,b"), (None, "c")
    ]


def test_lineage_names_the_file(spark, table, tmp_path):
    sinks.write_files(table, str(tmp_path / "in"), "json", files=1)
    traced = files.with_lineage(files.read_json(spark, str(tmp_path / "in"), SCHEMA)).first()
    assert traced["_source_file"].endswith(".json") and traced["_ingested_at"] is not None


def test_partition_pruning(spark, table, tmp_path):
    path = str(tmp_path / "parted")
    sinks.write_files(table, path, partition_by=["id"])
    one = spark.read.parquet(path).filter("id = 2")
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(id" in one._jdf.queryExecution().toString()


def test_file_counts(spark, tmp_path):
    numbers = spark.range(1000).repartition(8)
    sinks.write_files(numbers, str(tmp_path / "even"), files=3)
    sinks.write_files(numbers, str(tmp_path / "merged"), files=2, even=False)
    assert len(spark.read.parquet(str(tmp_path / "even")).inputFiles()) == 3
    assert len(spark.read.parquet(str(tmp_path / "merged")).inputFiles()) == 2


def test_typed_table(spark, tmp_path):
    name = f"typed_{tmp_path.name.replace('-', '_')}"
    sinks.create_table(spark, name, SCHEMA)
    sinks.create_table(spark, name, SCHEMA)
    sinks.write_table(spark.createDataFrame(DATA, SCHEMA), name)
    assert spark.table(name).count() == 3
    assert spark.table(name).schema["x"].dataType == T.DoubleType()
    spark.sql(f"DROP TABLE {name}")


def test_strides_need_sane_bounds(spark):
    with pytest.raises(ValueError):
        databases.read_in_strides(spark, "jdbc:none", "t", "id", 5, 5, 4)


def test_stream_reads_each_file_once(spark, table, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    sinks.write_files(table, source, "csv", files=1)

    def run():
        stream = ingest.stream_csv_strings(spark, source, ["id", "name", "x"])
        finish(append_to_files(stream, f"{base}/data", f"{base}/checkpoint"))
        return spark.read.parquet(f"{base}/data")

    first = run()
    assert dict(first.dtypes)["x"] == "string" and first.count() == 3
    assert run().count() == 3
    sinks.write_files(table, source, "csv", mode="append", files=1)
    assert run().count() == 6


def test_orders_are_typed_and_filtered(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"order_id": 1, "customer_id": "7", "product_id": "p", "quantity": 2, "amount": 3.10, "order_date": "2024-01-02 03:04:05"}\n'
        '{"order_id": 2, "customer_id": 7, "product_id": "p", "quantity": 0, "amount": 1.0, "order_date": "2024-01-02 03:04:05"}\n'
    )
    base = str(tmp_path / "out")
    finish(append_to_files(ingest.stream_orders(spark, str(tmp_path / "*.json")), f"{base}/d", f"{base}/c"))
    landed = spark.read.parquet(f"{base}/d")
    assert dict(landed.dtypes)["amount"] == "decimal(10,2)"
    assert [str(r["amount"]) for r in landed.collect()] == ["3.10"]


def test_states_side_by_side(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id INT, name STRING")
    states.write_state(table, path, 0, "create")
    for _ in range(2):  # a repeated write replaces itself
        states.write_state(table.filter("id > 1"), path, 1, "delete")
    assert states.latest_version(spark, path) == 1
    assert rows(states.read_state(spark, path, 0)) == rows(table)
    assert states.read_state(spark, path).columns == table.columns and states.read_state(spark, path).count() == 2
    assert rows(states.history(spark, path)) == [(0, "create", 3), (1, "delete", 2)]
    states.write_state(table.limit(0), path, 2, "empty")
    assert states.latest_version(spark, path) == 2 and states.read_state(spark, path).count() == 0


def test_clustering_lets_files_be_skipped(spark, rows, tmp_path):
    many = spark.range(4000).select("id", (F.col("id") * 7919 % 100).alias("zone")).repartition(8)
    states.write_state(states.clustered(many, "zone", 3), str(tmp_path / "t"), 0, "compact")
    kept = states.read_state(spark, str(tmp_path / "t"))
    assert rows(kept) == rows(many)
    spans = kept.groupBy(F.input_file_name()).agg(F.min("zone"), F.max("zone")).collect()
    assert len(spans) == 3 and sorted(s[2] for s in spans)[0] <= sorted(s[1] for s in spans)[-1]


def test_clustered_files_hold_a_bounded_number_of_rows(spark, rows, tmp_path):
    many = spark.range(8000).select("id", (F.col("id") * 7919 % 100).alias("zone")).repartition(8)
    for name, laid in (("one", states.clustered(many, "zone", 2, file_rows=1000)), ("all", states.clustered_by_all(many, ["zone", "id"], 2, file_rows=1000))):
        states.write_state(laid, str(tmp_path / name), 0, "compact")
        kept = states.read_state(spark, str(tmp_path / name))
        sizes = [r["count"] for r in kept.groupBy(F.input_file_name()).count().collect()]
        assert rows(kept) == rows(many) and len(sizes) <= 8 and max(sizes) < 2000


def test_clustering_spreads_one_value(spark, tmp_path):
    same = spark.range(4000).select("id", F.lit(1).alias("zone"))
    states.write_state(states.clustered(same, "zone", 4), str(tmp_path / "t"), 0, "compact")
    sizes = [r["count"] for r in states.read_state(spark, str(tmp_path / "t")).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000


SHAPE = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("at", T.DateType()), T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("name", T.StringType()),
])


def test_json_fields_are_rescued_one_by_one(spark, rows):
    lines = [
        '{"id": 1, "at": "2024-01-02", "tags": ["a"], "name": "x"}',
        '{"id": "one", "at": "2024-01-02", "name": "y", "more": {"a": [1]}}',
        '{"id": 3, "at": "someday", "tags": "none", "name": null}',
        '{"other": 5}', "no json", "", "[1, 2]", None,
    ]
    found = files.json_by_field(spark.createDataFrame([(line,) for line in lines], "value STRING"), SHAPE).collect()
    day = datetime.date(2024, 1, 2)
    kept = [tuple(r)[:4] for r in found]
    assert kept == [(1, day, ["a"], "x"), (None, day, None, "y"), (3, None, None, None)] + [(None,) * 4] * 5
    rescued = [json.loads(r[4]) if r[4] else None for r in found]
    assert rescued[:3] == [None, {"id": "one", "more": '{"a":[1]}'}, {"at": "someday", "tags": "none"}]
    assert rescued[3] == {"other": "5"} and rescued[4] == {"_line": "no json"} and rescued[7] is None


def test_csv_fields_are_rescued_one_by_one(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    lines = ['1,"a, b"', "x,c", "2", "3,d,extra,more", "y,e,extra", "4,f,1,2,3", None]
    found = files.csv_by_field(spark.createDataFrame([(line,) for line in lines], "value STRING"), schema, extra=2).collect()
    assert [tuple(r)[:2] for r in found] == [(1, "a, b"), (None, "c"), (2, None), (3, "d"), (None, "e"), (4, "f"), (None, None)]
    rescued = [json.loads(r[2]) if r[2] else None for r in found]
    assert rescued == [None, {"id": "x"}, None, {"_extra_1": "extra", "_extra_2": "more"}, {"id": "y", "_extra_1": "extra"}, {"_line": "4,f,1,2,3"}, None]


def test_rescue_by_field_in_a_stream(spark, tmp_path):
    spark.createDataFrame([('{"id": "x", "name": "n"}',)], "value STRING").write.text(str(tmp_path / "in"))
    stream = files.json_by_field(spark.readStream.text(str(tmp_path / "in")), SHAPE)
    finish(append_to_files(stream, str(tmp_path / "out"), str(tmp_path / "c")))
    (row,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert (row.id, row.name, row._rescued) == (None, "n", '{"id":"x"}')


def test_a_model_is_trained_once(spark, tmp_path):
    from tallyforge.operators import models

    rows = spark.createDataFrame([(w, int(w == "good")) for w in ["good", "bad"] * 20], "text STRING, label INT")
    fits = []

    def fit():
        fits.append(1)
        return models.fit_text_classifier(rows, "text", "label")

    first, second = (models.trained_once(spark, str(tmp_path / "model"), fit) for _ in range(2))
    assert len(fits) == 1
    scores = [[tuple(r.scored) for r in models.score_sentiment(m, rows).collect()] for m in (first, second)]
    assert scores[0] == scores[1] and {s[0] for s in scores[0]} == {"POSITIVE", "NEGATIVE"}
