"""Batch scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

RESCUED = "_rescued"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row. Without a schema Spark reads the file once more to infer the types."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def with_rescue(schema: T.StructType) -> T.StructType:
    """The schema plus a column that takes the raw line of a row that does not fit."""
    return T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])


# The parser has to look at whole lines, also when a query uses few columns.
RESCUE_OPTIONS = {"columnNameOfCorruptRecord": RESCUED, "columnPruning": "false"}


def read_csv_rescued(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> DataFrame:
    """CSV where a malformed line is kept whole in _rescued instead of being lost."""
    reader = spark.read.options(**RESCUE_OPTIONS).option("header", header)
    return reader.schema(with_rescue(schema)).csv(path)


def _by_field(lines: DataFrame, fields: Column, schema: T.StructType, lost: Column) -> DataFrame:
    """The typed fields of a map of texts, and as JSON in _rescued the texts that have no column or don't fit its type.

    Where `lost` holds, the map doesn't have all of the line; then _rescued has the line itself, as `_line`.
    """
    typed, misfit = {}, {}
    for field in schema.fields:
        raw = F.try_element_at(fields, F.lit(field.name))
        nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
        typed[field.name] = F.from_json(raw, field.dataType) if nested else raw.try_cast(field.dataType)
        misfit[field.name] = raw.isNotNull() & typed[field.name].isNull()
    expected = F.array(*[F.lit(name) for name in typed])
    misfits = F.array_compact(F.array(*[F.when(wrong, F.lit(name)) for name, wrong in misfit.items()]))
    left = F.map_filter(fields, lambda k, v: v.isNotNull() & (~F.array_contains(expected, k) | F.array_contains(misfits, k)))
    rescued = F.when(lost, F.to_json(F.create_map(F.lit("_line"), F.col("value")))).when(F.size(left) > 0, F.to_json(left))
    return lines.select(*[column.alias(name) for name, column in typed.items()], rescued.alias(RESCUED))


def json_by_field(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns from JSON lines (column value), batch or stream; what doesn't fit is rescued field by field.

    A field of the wrong type is NULL in its column and keeps its text in _rescued, next to fields that the schema doesn't have;
    the rest of the row stays typed. _rescued is NULL where all fits. A line that is no JSON object is rescued whole.
    """
    fields = F.from_json("value", "map<string,string>")
    held = lines.select("value", fields.alias("_fields"))
    return _by_field(held, F.col("_fields"), schema, F.col("_fields").isNull() & F.col("value").isNotNull())


def csv_by_field(lines: DataFrame, schema: T.StructType, extra: int = 16) -> DataFrame:
    """Typed columns from delimited lines (column value), batch or stream, rescued field by field as in `json_by_field`.

    Quotes are honoured. Fields beyond the schema are rescued as `_extra_1` and so on; a line with more than `extra` of them whole.
    """
    names = [*schema.fieldNames(), *(f"_extra_{i + 1}" for i in range(extra + 1))]
    row = lines.select("value", F.from_csv("value", ", ".join(f"`{n}` STRING" for n in names)).alias("_row"))
    pairs = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col("_row")[n] for n in names]))
    held = row.select("value", pairs.alias("_fields"), F.col("_row")[names[-1]].isNotNull().alias("_lost"))
    return _by_field(held, F.col("_fields"), schema, F.col("_lost"))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines."""
    return spark.read.schema(schema).json(path) if schema else spark.read.json(path)


def read_lines(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """One row per line in column value; lines equal to `header` are dropped."""
    lines = spark.read.text(path)
    return lines if header is None else lines.filter(F.col("value") != header)


def split_fields(lines: DataFrame, schema: str) -> DataFrame:
    """Typed columns from delimited lines. Quotes are honoured; a malformed field becomes NULL."""
    return lines.select(F.from_csv("value", schema).alias("row")).select("row.*")


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the source file and the time of ingest; batch and stream."""
    return df.withColumns(
        {"_source_file": F.col("_metadata.file_path"), "_ingested_at": F.current_timestamp()}
    )
