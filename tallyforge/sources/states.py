"""States of a table side by side, as plain Parquet partitioned by version and operation.

    <path>/version=0/operation=create/...

The caller numbers the versions. Writing one again replaces it, so a repeated job or batch leaves the same state.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_PARTITIONS = ("version", "operation")
#: What a task sorts at most for one file.
FILE_ROWS = 3 << 20


def write_state(df: DataFrame, path: str, version: int, operation: str) -> None:
    """Write `df` as one state."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}/operation={operation}")


def latest_version(spark: SparkSession, path: str) -> int:
    """The highest number written, also if that state has no rows. Reads file names only."""
    return max(int(n) for name in spark.read.parquet(path).inputFiles() for n in re.findall(r"/version=(\d+)/", name))


def read_state(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The latest state, or an older one. Only its folder is read."""
    version = latest_version(spark, path) if version is None else version
    return spark.read.parquet(path).where(F.col("version") == version).drop(*_PARTITIONS)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Rows (version, operation, rows) for the states that have rows, counted from the files."""
    return spark.read.parquet(path).groupBy(*_PARTITIONS).agg(F.count("*").alias("rows"))


def _files_for(df: DataFrame, files: int, file_rows: int) -> int:
    """`files`, or more where a file would get over `file_rows` rows, as one task sorts the rows of a file. Counts the rows."""
    return max(files, ceil(df.count() / file_rows))


def clustered(df: DataFrame, column: str, files: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """At most `files` partitions, clustered on a column; more for a table of over `files` times `file_rows` rows.

    Rows near in `column` share a file, so a filter on it skips the others. A
    hash of the row breaks ties, which spreads a value with very many rows.
    """
    spread = F.xxhash64(*df.columns)
    return df.repartitionByRange(_files_for(df, files, file_rows), F.col(column), spread).sortWithinPartitions(column)


def _number_of(df: DataFrame, column: str) -> Column:
    """A number in the order of the column's values: times by their position in time, texts by their first six bytes."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def curve_place(ranks: Sequence[Column], bits: int) -> Column:
    """The place on a space-filling curve (Z-order): the bits of all ranks, interleaved, highest first."""
    place = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(rank, bit).bitwiseAND(1))
    return place


def clustered_by_all(df: DataFrame, columns: Sequence[str], files: int, bits: int = 6, file_rows: int = FILE_ROWS) -> DataFrame:
    """At most `files` partitions, clustered on several columns at once; more for a table of over `files` times `file_rows` rows.

    Each column becomes its rank among 2^bits ranges of equal row counts, and rows are laid out along a curve through these ranks. So a
    filter on any one of the columns skips most files, where plain clustering serves the first only. NULL has rank 0. The
    bounds of the ranges, 2^bits numbers for each column, are found in one pass.
    """
    points = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = {c: _number_of(df, c) for c in columns}
    bounds = df.agg(*[F.percentile_approx(n, points, 100 << bits).alias(f"b{i}") for i, n in enumerate(numbers.values())]).first()

    def rank(number: Column, known: list[float]) -> Column:
        """How many bounds lie below the number: a look at a short constant array."""
        below = F.size(F.filter(F.array(*[F.lit(float(b)) for b in known]), lambda b: b < number)) if known else F.lit(0)
        return F.coalesce(F.when(number.isNotNull(), below), F.lit(0)).cast("long")

    # Values that repeat a lot take few of the ranges; the others keep their order.
    ranks = [rank(number, sorted(set(bounds[i] or []))) for i, number in enumerate(numbers.values())]
    laid = df.withColumn("_place", curve_place(ranks, bits))
    return laid.repartitionByRange(_files_for(df, files, file_rows), "_place", F.xxhash64(*df.columns)).sortWithinPartitions("_place").drop("_place")
