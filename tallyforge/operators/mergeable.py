"""Partial aggregates that are stored once and merged later, to any coarser key or longer period.

A `Measure` says how a column of raw rows is aggregated, how stored results of it are merged, and what is read from a
merged one. Sums, counts and extremes are exact; distinct counts and quantiles are kept as sketches of bounded size, or
exactly as bitmaps where ids are dense whole numbers.

    parts = partials(rows, ["day", "shop"], MEASURES)          # written by day
    finished(merged(parts, ["shop"], MEASURES), MEASURES)      # any days, without the rows
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Size of a distinct-count sketch: 2^12 registers, a relative standard error of 1.04 / sqrt(2^12) = 1.6 %.
REGISTERS = 12
DISTINCT_ERROR = 1.04 / 2 ** (REGISTERS / 2)
#: Size of a quantile sketch: ranks are off by about 1.33 % at most, with a confidence of 99 %.
SKETCH_ITEMS = 200
RANK_ERROR = 0.0133


@dataclass(frozen=True)
class Measure:
    """`partial` aggregates raw rows; `merge` aggregates a stored column; `result` reads one that is merged."""

    partial: Callable[[], Column]
    merge: Callable[[str], Column]
    result: Callable[[str], Column] = F.col


def total(column: str) -> Measure:
    """An exact sum; NULL without a value."""
    return Measure(lambda: F.sum(column), F.sum)


def row_count() -> Measure:
    return Measure(lambda: F.count("*"), F.sum)


def known_count(column: str) -> Measure:
    """Values that are not NULL."""
    return Measure(lambda: F.count(column), F.sum)


def smallest(column: str) -> Measure:
    return Measure(lambda: F.min(column), F.min)


def largest(column: str) -> Measure:
    return Measure(lambda: F.max(column), F.max)


def distinct(column: str, registers: int = REGISTERS) -> Measure:
    """Distinct values, approximately; NULL isn't one. Merged sketches keep the error of one sketch of all rows."""
    return Measure(
        lambda: F.hll_sketch_agg(column, F.lit(registers)), F.hll_union_agg,
        lambda c: F.coalesce(F.hll_sketch_estimate(c), F.lit(0).cast("long")),
    )


def quantiles(column: str, points: Sequence[float], items: int = SKETCH_ITEMS) -> Measure:
    """An array with a value of the data near each point, approximately; NULL without a value."""

    def read(c: str) -> Column:
        wanted = F.array(*[F.lit(float(p)) for p in points])
        known = F.kll_sketch_get_n_double(c) > 0
        return F.when(known, F.kll_sketch_get_quantile_double(F.when(known, F.col(c)), wanted))

    return Measure(
        lambda: F.kll_sketch_agg_double(F.col(column).cast("double"), items), lambda c: F.kll_merge_agg_double(c, items), read,
    )


def partials(rows: DataFrame, keys: Sequence[str | Column], measures: Mapping[str, Measure]) -> DataFrame:
    """The keys and a stored form of each measure."""
    return rows.groupBy(*keys).agg(*[m.partial().alias(name) for name, m in measures.items()])


def merged(parts: DataFrame, keys: Sequence[str | Column], measures: Mapping[str, Measure]) -> DataFrame:
    """Stored forms merged to keys that are coarser, or to the same keys where they occur several times."""
    return parts.groupBy(*keys).agg(*[m.merge(name).alias(name) for name, m in measures.items()])


def finished(parts: DataFrame, measures: Mapping[str, Measure]) -> DataFrame:
    """The results in place of the stored forms."""
    return parts.withColumns({name: m.result(name) for name, m in measures.items()})


def id_bitmaps(rows: DataFrame, keys: Sequence[str], ids: str, **measures: Column) -> DataFrame:
    """The keys, `bucket`, `ids` (a bitmap of the ids of this bucket), and any other aggregates of the rows, which add up over buckets.

    Exact and mergeable distinct counts for whole numbers: a bucket spans 32,768 ids, so ids should be dense. Each
    id is one row per key before bitmaps are built; raw rows are shuffled once, after adding up what a task has. NULL
    ids are in no bitmap; their rows have a NULL bucket.
    """
    place = {"bucket": F.bitmap_bucket_number(ids), "_place": F.bitmap_bit_position(ids)}
    once = rows.withColumns(place).groupBy(*keys, "bucket", "_place").agg(*[c.alias(n) for n, c in measures.items()])
    return once.groupBy(*keys, "bucket").agg(
        F.bitmap_construct_agg("_place").alias("ids"), *[F.sum(n).alias(n) for n in measures]
    )


def merged_bitmaps(cells: DataFrame, keys: Sequence[str], *sums: str) -> DataFrame:
    """Bitmaps or'ed to coarser keys, still by bucket, and the other columns added up."""
    return cells.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"), *[F.sum(s).alias(s) for s in sums])


def counted_bitmaps(cells: DataFrame, keys: Sequence[str], name: str, *sums: str) -> DataFrame:
    """The number of distinct ids of each key, as `name`, and the sums."""
    known = F.when(F.col("bucket").isNotNull(), F.bitmap_count("ids")).otherwise(0)
    return cells.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums], F.sum(known).alias(name))
