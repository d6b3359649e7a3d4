"""Ranking, running and moving figures per key.

The running and moving figures expect a table that is already aggregated to one
row per key and period: a key then has as many rows as periods, however many raw
rows stand behind it. For raw rows, where a key may have very many, use `scans`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyforge.functions.tiers import above, below
from tallyforge.operators.skew import salted_join


def top_by_rank(df: DataFrame, group: str, value: str, tie_break: str, k: int = 3) -> DataFrame:
    """Rows of rank 1..k per group, ties kept, with rank and row_number.

    The rank filter is applied before and after the shuffle (WindowGroupLimit).
    """
    by_value = Window.partitionBy(group).orderBy(F.col(value).desc())
    ranked = df.withColumn("rank", F.rank().over(by_value)).filter(F.col("rank") <= k)
    numbered = Window.partitionBy(group).orderBy(F.col(value).desc(), F.col(tie_break))
    return ranked.withColumn("row_number", F.row_number().over(numbered))


def moving(df: DataFrame, key: str, order: Sequence[str], rows: int | None = None, **figures: Column) -> DataFrame:
    """Add aggregates over a row and those before it in its key: the last `rows` rows, or all so far."""
    first = Window.unboundedPreceding if rows is None else 1 - rows
    frame = Window.partitionBy(key).orderBy(*order).rowsBetween(first, Window.currentRow)
    return df.withColumns({name: figure.over(frame) for name, figure in figures.items()})


def neighbours(df: DataFrame, key: str, order: Sequence[str], value: str, **steps: int) -> DataFrame:
    """Add the value of other rows of the key, so many steps back; a negative number looks ahead."""
    in_order = Window.partitionBy(key).orderBy(*order)
    return df.withColumns({name: F.lag(value, back).over(in_order) for name, back in steps.items()})


def change_pct(now: str, before: str) -> Column:
    """Change from one column to another in %; NULL without a value or from 0."""
    return F.try_divide(F.col(now) - F.col(before), F.col(before)) * 100


def running_growth(df: DataFrame, key: str, periods: Sequence[str], value: str) -> DataFrame:
    """Running total, previous period and growth in %, 0 for the first period of a key."""
    totals = moving(df, key, periods, running_total=F.sum(value))
    known = neighbours(totals, key, periods, value, previous_total=1)
    first = F.col("previous_total").isNull()
    return known.withColumn("growth_pct", F.when(first, 0.0).otherwise(change_pct(value, "previous_total")))


# Labels of a difference, of a change in %, and of a distance in deviations.
AGAINST_AVERAGE = ((0, "Above Average"),), ((0, "Below Average"),), "At Average"
CHANGE = ((10, "Strong Growth"), (0, "Growth"), (-10, "Stable")), "Decline"
DEVIATION = ((2, "ANOMALY"), (1, "WARNING")), "NORMAL"


def against_average(difference: Column) -> Column:
    """Label of a value's difference from an average."""
    over, under, level = AGAINST_AVERAGE
    return above(difference, over, below(difference, under, level))


def change_label(change: Column) -> Column:
    """Label of a change in %."""
    return above(change, *CHANGE)


def label_deviation(
    df: DataFrame, keys: Sequence[str], value: str, spread_by: Sequence[str] | None = None, hot: Mapping[int, int] | None = None
) -> DataFrame:
    """health_status of a row by its distance from its group's mean, in deviations of the group; NULL keys are a group.

    The figures of a group are aggregated and joined back, one row per group. The rows of a group that holds many of
    them are spread over tasks by the columns in `spread_by` (all by default). Which groups are large is measured
    first, in a job of its own; `hot` takes the result of `skew.hot_keys` where it is known.
    """
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.stddev(value).alias("_sd"))
    limits, rest = DEVIATION
    far = F.abs(F.col(value) - F.col("_mean"))
    label = above(far, [(times * F.col("_sd"), name) for times, name in limits], rest)
    joined = salted_join(df, stats, keys, spread_by or df.columns, hot=hot, null_safe=True)
    return joined.withColumn("health_status", label).drop("_mean", "_sd")
