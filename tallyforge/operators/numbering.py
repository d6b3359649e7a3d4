"""Row numbers and ranks over a whole table, computed in parallel.

A window without PARTITION BY sends every row to one task. Here the table is
range-partitioned on the order, each partition counts on its own, and only the
sizes of the partitions are added up on the driver.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyforge.session import stored

# monotonically_increasing_id keeps the partition above bit 33, the position below.
_POSITION_BITS = 33


def sorted_slices(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range-partitioned and sorted copy of `df` with columns _slice and _pos, written once.

    Writing it fixes which row lies in which slice, also when an executor is lost.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = (
        df.repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_id", _POSITION_BITS).cast("int"))
        .withColumn("_pos", F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_id")
    )
    return stored(laid, "slices")


def _with_offsets(laid: DataFrame, weight: Column) -> tuple[DataFrame, int]:
    """Add _before, the weight of all earlier slices. Collects one number per slice."""
    sizes = (
        laid.groupBy("_slice").agg(F.sum(weight).alias("w")).orderBy("_slice").collect()
    )
    ends = list(accumulate(row["w"] for row in sizes))
    rows = [(row["_slice"], end - row["w"]) for row, end in zip(sizes, ends)]
    offsets = laid.sparkSession.createDataFrame(rows, "_slice int, _before long")
    # One row per shuffle partition.
    return laid.join(F.broadcast(offsets), "_slice"), (ends[-1] if ends else 0)


def number_rows(df: DataFrame, *order: Column, name: str = "row_number") -> DataFrame:
    """Number all rows 1..n in the given order. End the order with a unique column."""
    numbered, _ = _with_offsets(sorted_slices(df, list(order)), F.lit(1))
    return numbered.select(*df.columns, (F.col("_before") + F.col("_pos") + 1).alias(name))


def ordered_batches(df: DataFrame, batches: int, *order: Column, name: str = "batch_id") -> DataFrame:
    """Cut all rows, in order, into `batches` runs of equal length; the last also takes the remainder."""
    numbered, total = _with_offsets(sorted_slices(df, list(order)), F.lit(1))
    length = max(1, total // batches)
    position = F.col("_before") + F.col("_pos")
    batch = F.least(F.floor(position / F.lit(length)), F.lit(batches - 1))
    return numbered.select(*df.columns, batch.cast("int").alias(name))


def ordered_parts(df: DataFrame, parts: int, *order: Column) -> list[DataFrame]:
    """The runs of `ordered_batches` as tables of their own, each of which reads only the slices that it lies in."""
    laid = sorted_slices(df, list(order))
    sizes = laid.groupBy("_slice").agg(F.count("*").alias("n")).orderBy("_slice").collect()  # one number per slice
    ends = list(accumulate(row["n"] for row in sizes))
    total = ends[-1] if ends else 0
    length, out = max(1, total // parts), []
    for part in range(parts):
        first, last = part * length, total if part == parts - 1 else min(total, (part + 1) * length)
        mine = [(row["_slice"], end - row["n"]) for row, end in zip(sizes, ends) if end > first and end - row["n"] < last]
        if not mine:
            out.append(laid.limit(0).select(*df.columns))
            continue
        # All slices between the first and the last lie in the part as a whole.
        (low, before), (high, before_high) = mine[0], mine[-1]
        here = F.col("_slice").between(low, high)
        here = here & ((F.col("_slice") != low) | (F.col("_pos") >= first - before)) & ((F.col("_slice") != high) | (F.col("_pos") < last - before_high))
        out.append(laid.where(here).select(*df.columns))
    return out


def percent_rank(df: DataFrame, value: str, descending: bool = True, name: str = "percent_rank") -> DataFrame:
    """PERCENT_RANK over the whole table: (rank - 1) / (rows - 1), ties share a rank.

    Works on the distinct values with their counts, then joins the rank back. The rows are written once: were they
    computed twice, a value such as a sum of doubles could differ in its last bit, and its row would find no rank.
    """
    df = stored(df, "ranked-rows")
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    laid, total = _with_offsets(sorted_slices(counts, [order]), F.col("_n"))
    in_slice = (
        Window.partitionBy("_slice").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = F.col("_before") + F.coalesce(F.sum("_n").over(in_slice), F.lit(0))
    ranks = laid.select(
        F.col(value).alias("_value"), (earlier / F.lit(float(max(total - 1, 1)))).alias(name)
    )
    return df.join(ranks, df[value].eqNullSafe(F.col("_value"))).drop("_value")
