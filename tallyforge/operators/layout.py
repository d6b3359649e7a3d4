"""Partitioning and caching that a user controls."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows (partition, row_count)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("row_count"))


def partition_sample(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first `rows` rows of each partition with its number; no shuffle."""
    numbered = df.withColumn("partition", F.spark_partition_id())

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = rows
        for batch in batches:
            if left <= 0:
                return
            yield batch.slice(0, left)
            left -= batch.num_rows

    return numbered.mapInArrow(head, numbered.schema)


def by_key(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Hash partitioning: equal keys meet in one partition."""
    return df.repartition(partitions, *keys)


def spread_out(scan: DataFrame) -> DataFrame:
    """Even partitions for a file scan that has fewer of them than there are cores.

    For CPU-heavy work on a few large row groups. A table with enough splits is
    returned as it is, without a shuffle. Pass a plain scan: its partitions are
    known before anything runs.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def bucket_of(df: DataFrame, parts: int, *keys: str, name: str = "bucket") -> DataFrame:
    """Number 0..parts-1 from the hash of the keys; never negative, so no row is lost."""
    return df.withColumn(name, F.pmod(F.hash(*keys), F.lit(parts)))


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a DataFrame for several actions and release it afterwards, also on an error.

    Filter and prune before: a kept DataFrame takes no further pushdown.
    """
    held = df.persist(level)
    try:
        yield held
    finally:
        held.unpersist()
