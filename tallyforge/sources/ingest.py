"""File streams: every new file is read once; the checkpoint of the sink remembers which."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamReader

from tallyforge.sources.files import RESCUE_OPTIONS, with_lineage, with_rescue

# The columns and types of order files.
ORDER_SCHEMA = (
    "order_id STRING, customer_id INT, product_id STRING, quantity INT, "
    "amount DECIMAL(10,2), order_date TIMESTAMP"
)


def limited(reader: DataStreamReader, max_files: int | None = None, max_bytes: int | None = None) -> DataStreamReader:
    """At most so many files, or about so many bytes, per batch, so that a backlog is not one huge batch."""
    if max_files and max_bytes:
        raise ValueError("limit either files or bytes per batch")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader


def stream_csv_strings(
    spark: SparkSession, path: str, columns: Sequence[str], max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """CSV files with every column as a string, the raw line of misfits, and lineage."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = limited(spark.readStream, max_files, max_bytes).options(**RESCUE_OPTIONS).option("header", True)
    return with_lineage(reader.schema(with_rescue(schema)).csv(path))


def stream_json(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    return limited(spark.readStream, max_files, max_bytes).schema(schema).json(path)


def inferred_json_schema(spark: SparkSession, sample_path: str) -> T.StructType:
    """Schema of files that are already there, to declare for a stream."""
    return spark.read.json(sample_path).schema


def stream_orders(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Order files, typed; orders without a positive quantity are dropped."""
    return stream_json(spark, path, ORDER_SCHEMA, max_files, max_bytes).filter("quantity > 0")


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None, name: str | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Parquet files of a table as a stream, oldest first, with a limit per batch.

    `name` restricts the stream to files of that name. Timestamps without a zone
    are read as UTC instants, which watermarks need.
    """
    reader = limited(spark.readStream, max_files, max_bytes).schema(schema)
    if name:
        reader = reader.option("pathGlobFilter", name)
    stream = reader.parquet(path)
    zoned = {
        f.name: F.col(f.name).cast("timestamp")
        for f in schema.fields
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return stream.withColumns(zoned) if zoned else stream
