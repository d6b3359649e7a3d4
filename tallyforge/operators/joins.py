"""Join shapes used by the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.operators.skew import salted_join


def join_with(left: DataFrame, right: DataFrame, condition: Column, right_columns: Mapping[str, str],
              how: str = "inner") -> DataFrame:
    """All columns of `l`, plus chosen columns of `r` under new names.

    `condition` refers to the sides as l.x and r.y.
    """
    picked = [F.col(f"r.`{old}`").alias(new) for old, new in right_columns.items()]
    return left.alias("l").join(right.alias("r"), condition, how).select("l.*", *picked)


def without_match(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Rows of `left` whose key does not occur in `right`, NULL keys included.

    Only the distinct keys of `right` travel, so repeated keys there cost nothing.
    With `spread_by`, columns that tell the rows of one key apart, keys that repeat
    a lot in `left` are spread over tasks.
    """
    keys = right.select(F.col(right_key).alias(left_key)).dropna().distinct()
    if spread_by:
        return salted_join(left, keys, [left_key], spread_by, "left_anti").select(*left.columns)
    return left.join(keys, left_key, "left_anti").select(*left.columns)


def merge_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], counts: Sequence[str],
                 shared: Sequence[str] = ()) -> DataFrame:
    """Full outer join of two aggregates: missing counts become 0, `shared` columns are coalesced.

    Both sides hold one row per key, so the join moves aggregates, not raw rows.
    """
    joined = left.alias("l").join(right.alias("r"), list(keys), "full_outer")
    both = [F.coalesce(f"l.{c}", f"r.{c}").alias(c) for c in shared]
    return joined.select(*keys, *both, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])


def consecutive_months(df: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """Pair each month (yyyy-MM) of a key with the calendar month before it, with the growth in %.

    `df` holds one row per key and month.
    """
    previous = df.select(
        key,
        F.date_format(F.add_months(F.to_date(month, "yyyy-MM"), 1), "yyyy-MM").alias(month),
        F.col(value).alias("previous_value"),
    )
    growth = F.try_divide(F.col(value) - F.col("previous_value"), F.col("previous_value")) * 100
    return df.join(previous, [key, month]).select(
        key, month, value, "previous_value", growth.alias("growth_rate")
    )
