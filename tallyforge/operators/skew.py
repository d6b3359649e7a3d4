"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# The most keys that the sketch behind `hot_keys` can report and track.
_MOST_KEYS, _MOST_TRACKED = 100_000, 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> dict[int, int]:
    """The keys larger than two mean shuffle partitions: hash of the key to the number of tasks it needs.

    A key gets as many tasks as it has mean partitions' worth of rows, by its measured count. There are fewer such keys
    than half the partitions. One pass with a frequent-items sketch, so the keys themselves are not
    shuffled. This runs a job: find the keys of a table once, and pass them to every join that needs them.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(_MOST_KEYS, partitions // 2 + 1)
    tracked = min(_MOST_TRACKED, 32 * partitions + 1_000)
    found = (
        df.select(F.xxhash64(*keys).alias("h"))
        .agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {most}, {tracked})").alias("top"))
        .first()
    )
    mean = max(1.0, found["n"] / partitions)
    return {e["item"]: math.ceil(e["count"] / mean) for e in found["top"] or [] if e["count"] > 2 * mean}


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    hot: Mapping[int, int] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join on `keys`, spreading each hot key of `left` over several tasks. With `null_safe` NULL keys match each other.

    Rows of hot keys get a salt computed from `spread_by` (columns that tell the
    rows of one key apart, such as an id), and the matching rows of `right` are
    repeated once per salt. Other rows are not touched. Use it where the right
    side is an aggregate on the join key: adaptive execution splits skew only
    between two plain shuffles. `hot` takes the result of `hot_keys`, which is
    computed here if it is not given.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} would repeat rows of the salted right side")
    hot = hot_keys(left, keys) if hot is None else hot
    if not hot:
        return _joined(left, right, keys, how, null_safe)
    parts = F.create_map(*[F.lit(x).cast("bigint") for pair in hot.items() for x in pair])
    salts = F.coalesce(F.try_element_at(parts, F.xxhash64(*keys)), F.lit(1).cast("bigint"))
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), salts))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
    return _joined(salted_left, salted_right, [*keys, "_salt"], how, null_safe).drop("_salt")


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, list(keys), how)
    other = {k: f"_right_{i}" for i, k in enumerate(keys)}
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()])
    return left.join(right.withColumnsRenamed(other), same, how).drop(*other.values())


def is_small(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> bool:
    """Whether the table stays within both bounds. Reads at most `max_rows + 1` rows."""
    width = F.lit(0)
    for field in df.schema.fields:
        if field.dataType.typeName() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif field.dataType.typeName() in ("array", "map", "struct"):
            width = width + F.octet_length(F.to_json(F.struct(field.name)))
        else:
            width = width + F.lit(8)
    seen = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(width).alias("b")).first()
    return seen["n"] <= max_rows and (seen["b"] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast only after measuring the table; otherwise leave the choice to Spark."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
