"""Attach a one-row aggregate to every row, without a join and without the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_totals(df: DataFrame, one_row: DataFrame, *columns: str) -> DataFrame:
    """Add the columns of `one_row`, an aggregate without keys, to every row of `df`.

    The one row travels as a scalar subquery. Spark fails the query if it turns
    out to hold more than one row, so the size of what is broadcast is certain.
    """
    names = columns or tuple(one_row.columns)
    packed = one_row.select(F.struct(*one_row.columns).alias("packed")).scalar()
    return df.withColumn("_totals", packed).select(
        *df.columns, *[F.col("_totals").getField(name).alias(name) for name in names]
    )
