"""Turn a table into a stream of ordered micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyforge.operators.numbering import ordered_parts
from tallyforge.sources.ingest import stream_parquet


def write_ordered_batches(
    df: DataFrame, path: str, time: str, unique: str, batches: int = 5, rows_per_file: int = 1_000_000
) -> int:
    """Cut the table into batches by time and write them as folders batch=0, batch=1, ... in that order.

    Every folder gets the same number of files of equal size. Returns that number: with as many files per
    trigger, `replay` reads one folder after the other. The table is sorted and written once; each folder is then
    copied from the slices of it that hold its rows.
    """
    parts = ordered_parts(df, batches, F.col(time), F.col(unique))
    files = max(1, parts[0].count() // rows_per_file)
    for batch, part in enumerate(parts):
        part.repartition(files).write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return files


def replay(spark: SparkSession, path: str, schema: T.StructType, files: int = 1) -> DataFrame:
    """Stream over the folders of `write_ordered_batches`, `files` files per trigger."""
    return stream_parquet(spark, f"{path}/batch=*", schema, max_files=files)
