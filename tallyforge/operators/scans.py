"""Running and moving figures over raw rows, where one key may hold a large share of them.

A window sends all rows of a key to one task. Here rows are range-partitioned on key and order, so a key with many rows
lies in many slices; each slice is scanned on its own, and only totals per key and slice are carried from one to
the next. What needs neighbouring rows works on chunks of a key of bounded length, each with copies of the few rows around it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyforge.operators.numbering import sorted_slices

#: Rows of a key that one task works on at a time.
CHUNK_ROWS = 1_000_000


def _carried(laid: DataFrame, keys: Sequence[str], **sums: Column) -> DataFrame:
    """`laid` with `_before_<name>`: each sum over the rows of the key in all earlier slices. A row per key and slice is joined back."""
    each = laid.groupBy(*keys, "_slice").agg(*[c.alias(f"_sum_{n}") for n, c in sums.items()])
    # At most as many rows in a frame as there are slices.
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    names = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    offsets = each.select(
        *names, F.col("_slice").alias("_in"), *[F.sum(f"_sum_{n}").over(earlier).alias(f"_before_{n}") for n in sums]
    )
    same = F.col("_slice") == F.col("_in")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return laid.join(offsets, same).drop("_in", *[f"_k{i}" for i in range(len(keys))])


def running(df: DataFrame, keys: Sequence[str], order: Sequence[Column], **values: Column) -> DataFrame:
    """Add the sum of each value over the row and those before it in its key; NULL until there is a value.

    `order` must tell the rows of a key apart. NULL keys are one key.
    """
    given = {f"_v_{n}": c for n, c in values.items()}
    laid = sorted_slices(df.withColumns(given), [*map(F.col, keys), *order])
    carried = _carried(laid, keys, **{n: F.sum(f"_v_{n}") for n in values})
    so_far = Window.partitionBy("_slice", *keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {}
    for n in values:
        here, before = F.sum(f"_v_{n}").over(so_far), F.col(f"_before_{n}")
        sums[n] = F.coalesce(here + before, here, before)
    return carried.select(*df.columns, *[c.alias(n) for n, c in sums.items()])


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "position") -> DataFrame:
    """Number the rows of each key from 0, in order."""
    return running(df, keys, order, **{name: F.lit(1)}).withColumn(name, F.col(name) - 1)


def framed(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], back: int = 0, ahead: int = 0, chunk_rows: int = CHUNK_ROWS,
    position: str | None = None, **figures,
) -> DataFrame:
    """Add figures that look at most `back` rows back and `ahead` rows ahead in the key.

    Each figure is a function of a window, which is ordered and without a frame: `lambda w: F.lag("v").over(w)`, or
    `lambda w: F.avg("v").over(w.rowsBetween(-2, 0))`. A chunk of a key gets copies of the rows around it that its own rows look at.
    `position` names a column with the rows of each key numbered from 0 in this order, where there is one already.
    """
    if chunk_rows <= 0:
        raise ValueError("chunk_rows must be positive")
    placed = df.withColumn("_at", F.col(position)) if position else positions(df, keys, order, "_at")
    first = F.floor((F.col("_at") - ahead) / F.lit(chunk_rows))
    last = F.floor((F.col("_at") + back) / F.lit(chunk_rows))
    seen = placed.withColumn("_chunk", F.explode(F.sequence(F.greatest(first, F.lit(0)).cast("long"), last.cast("long"))))
    window = Window.partitionBy(*keys, "_chunk").orderBy("_at")
    added = seen.withColumns({n: f(window) for n, f in figures.items()})
    own = F.col("_chunk") == F.floor(F.col("_at") / F.lit(chunk_rows))
    return added.where(own).select(*df.columns, *figures)


def weighted_quantiles(df: DataFrame, keys: Sequence[str], value: str, weight: str, **points: float) -> DataFrame:
    """For each key and point the smallest value at which the weights so far reach this share of all weights of the key.

    A value counts as often as its weight, a whole number, says; nothing is repeated. NULL values and weights below 1
    don't count. Weights are added up per value first, then over range partitions, so one key may hold most of the rows.
    """
    if not keys:
        raise ValueError("give at least one key")
    each = df.where(F.col(value).isNotNull() & (F.col(weight) >= 1)).groupBy(*keys, value).agg(F.sum(weight).cast("long").alias("_weight"))
    added = running(each, keys, [F.col(value)], _reached=F.col("_weight"))
    totals = each.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.sum("_weight").alias("_all"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    placed = added.join(totals, same)
    found = []
    for name, point in points.items():
        need = F.greatest(F.lit(1), F.ceil(F.round(F.lit(point) * F.col("_all"), 6)))
        hit = (F.col("_reached") >= need) & (F.col("_reached") - F.col("_weight") < need)
        found.append(F.max(F.when(hit, F.col(value))).alias(name))
    return placed.groupBy(*keys).agg(*found)
