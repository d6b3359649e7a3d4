"""Partitioned reads from a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_in_strides(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a table in `partitions` ranges of an integer column, one task each.

    The bounds only place the ranges; rows outside them are read too. Filters
    applied to the result are pushed to the database.
    """
    if partitions < 1 or upper <= lower:
        raise ValueError("need at least one partition and lower < upper")
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=properties or {},
    )
