"""Batch writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    files: int | None = None,
    even: bool = True,
) -> None:
    """Write csv, json, parquet or orc.

    `files` bounds the number of files: an even shuffle, or with even=False a
    merge of neighbouring partitions without a shuffle.
    """
    if files is not None:
        df = df.repartition(files) if even else df.coalesce(files)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_lines(df: DataFrame, path: str, separator: str = ",") -> None:
    """One text line per row."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(separator, *fields).alias("value")).write.mode("overwrite").text(path)


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """Create an empty typed table, and its schema, unless it exists; at `path` if given."""
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    if not spark.catalog.tableExists(name):
        writer = spark.createDataFrame([], schema).write.format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)


def write_table(df: DataFrame, name: str, mode: str = "append") -> None:
    """Append to, or overwrite, a catalog table; an append matches columns by name."""
    if mode == "append":
        df = df.select(*df.sparkSession.table(name).columns)
        df.write.insertInto(name)
    else:
        df.write.mode(mode).format("parquet").saveAsTable(name)
