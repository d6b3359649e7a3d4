"""De-duplication with a repeatable survivor."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

COPIES_PER_TASK = 1 << 19


def keep_first(df: DataFrame, keys: Sequence[str | Column], *order: Column) -> DataFrame:
    """One row per key: the first in `order`.

    Spark drops all but the first row per key before the shuffle as well
    (WindowGroupLimit), so a large group of copies never meets in one task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def digits_only(column: str) -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def keep_first_ignoring_case(
    df: DataFrame, text_keys: Sequence[str], order: Sequence[Column], exact_keys: Sequence[str] = ()
) -> DataFrame:
    """De-duplicate on lower-cased text keys; the surviving row keeps its spelling."""
    return keep_first(df, [F.lower(k) for k in text_keys] + [F.col(k) for k in exact_keys], *order)


def keep_first_standardised(
    df: DataFrame,
    text_keys: Sequence[str],
    digit_keys: Sequence[str],
    order: Sequence[Column],
    exact_keys: Sequence[str] = (),
) -> DataFrame:
    """De-duplicate on lower-cased text, digits of phone and zip, and exact keys."""
    keys = [F.lower(k) for k in text_keys]
    keys += [digits_only(k) for k in digit_keys]
    keys += [F.col(k) for k in exact_keys]
    return keep_first(df, keys, *order)


def with_noisy_copies(
    df: DataFrame, copies: int, upper_every: Mapping[str, int], partitions: int | None = None
) -> DataFrame:
    """Repeat each row `copies` times; column c is upper-cased in every upper_every[c]-th copy.

    `partitions` spreads the rows before they multiply, for an input of few partitions: over as many at least, and over
    more where one would get over `COPIES_PER_TASK` copies. So what sorts or counts them next fits in a task's memory.
    """
    spread = df.repartition(max(partitions, ceil(df.count() * copies / COPIES_PER_TASK))) if partitions else df
    repeated = spread.withColumn("duplicate_id", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    noisy = {
        column: F.when(F.col("duplicate_id") % step == 0, F.upper(column)).otherwise(F.col(column))
        for column, step in upper_every.items()
    }
    return repeated.withColumns(noisy)
