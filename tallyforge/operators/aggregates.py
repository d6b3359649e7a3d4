"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.operators.mergeable import counted_bitmaps, id_bitmaps, merged_bitmaps
from tallyforge.operators.scans import positions
from tallyforge.session import stored

# percentile_approx is off by at most 1/ACCURACY of the rows; its state grows with this number.
ACCURACY = 10_000


def summarise(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, sum, mean, min and max of a column per key."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.min(value).alias("smallest"),
        F.max(value).alias("largest"),
    )


def percentiles(value: str, points: Sequence[float], names: Sequence[str], accuracy: int = ACCURACY) -> list[Column]:
    """One percentile_approx column per point; each is an element of the data."""
    return [
        F.percentile_approx(value, point, accuracy).alias(name) for point, name in zip(points, names)
    ]


def described(df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float], **figures: Column) -> DataFrame:
    """Any figures per group, and approximate quantiles of one column, all named by the caller, in one pass."""
    named = [figure.alias(name) for name, figure in figures.items()]
    return df.groupBy(*keys).agg(*named, *percentiles(value, list(quantiles.values()), list(quantiles)))


# How the levels of a calendar are named, from the finest to the total.
LEVELS = {"month": "Month Detail", "quarter": "Quarter Total", "year": "Year Total", None: "Grand Total"}


def calendar_cells(df: DataFrame, date: str, amount: str, customer: str) -> DataFrame:
    """Per month and bucket of customers: sums, counts and a bitmap of the customers; small, exact and mergeable.

    Stored cells of several periods or tables can be united and merged by `rolled_up`. Customers are numbers.
    """
    rows = df.select(
        F.year(date).alias("year"), F.quarter(date).alias("quarter"), F.month(date).alias("month"),
        F.col(amount).alias("_amount"), F.col(customer).alias("_customer"),
    )
    return id_bitmaps(
        rows, ["year", "quarter", "month"], "_customer",
        total_sales=F.sum("_amount"), transaction_count=F.count("*"), known_amounts=F.count("_amount"),
    )


def rolled_up(cells: DataFrame) -> DataFrame:
    """Totals per month, quarter, year and overall from the cells of `calendar_cells`, labelled by level.

    Each level or's the bitmaps of the one below, so distinct customers are exact and no row is read again.
    """
    keys, sums, parts = ["year", "quarter", "month"], ("total_sales", "transaction_count", "known_amounts"), []
    for label in LEVELS.values():
        cells = merged_bitmaps(cells, keys, *sums)
        level = counted_bitmaps(cells, keys, "unique_customers", *sums)
        rest = {k: F.lit(None).cast("int") for k in ("year", "quarter", "month") if k not in keys}
        parts.append(level.withColumns(rest).withColumn("aggregation_level", F.lit(label)))
        keys = keys[:-1]
    both = reduce(DataFrame.unionByName, parts)
    return both.where("transaction_count is not null").select(
        "year", "quarter", "month", "total_sales", "transaction_count", "unique_customers",
        F.try_divide("total_sales", "known_amounts").alias("avg_transaction_amount"), "aggregation_level",
    )


def calendar_rollup(df: DataFrame, date: str, amount: str, customer: str) -> DataFrame:
    """Totals per month, quarter, year and overall, labelled by level; a NULL date stays a detail row.

    The rows are aggregated once to months; what they become is stored, and each level is made from the one below.
    """
    return rolled_up(stored(calendar_cells(df, date, amount, customer), "calendar-cells"))


def largest_total(df: DataFrame, key: str, value: str) -> DataFrame:
    """The key with the largest sum, the larger key on a tie: one row (key, total)."""
    totals = df.groupBy(key).agg(F.sum(value).alias("total"))
    return totals.agg(
        F.max_by(F.col(key), F.struct("total", key)).alias(key), F.max("total").alias("total")
    )


def word_counts(df: DataFrame, text: str, letters: str = "a-z") -> DataFrame:
    """Count words: lower-case, keep white space and the given letters, split on white space.

    Cleaning the text once before the split gives the same words as cleaning each word.
    """
    cleaned = F.regexp_replace(F.lower(text), rf"[^{letters}\s]", "")
    words = df.select(F.explode(F.split(cleaned, r"\s+")).alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(F.count("*").alias("count"))


def share_above(df: DataFrame, keys: Sequence[str], value: str, floor: float) -> DataFrame:
    """Rows, rows above `floor`, their share in % and the mean, per key."""
    above = F.sum(F.when(F.col(value) > floor, 1).otherwise(0))
    return df.groupBy(*keys).agg(
        F.count("*").alias("total_customers"),
        above.alias("high_value_customers"),
        F.avg(value).alias("avg_spending_per_customer"),
        (above * 100.0 / F.count("*")).alias("high_value_percentage"),
    )


def collect_distinct(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Sorted array of the distinct values per key.

    Pairs are made distinct first, so a key with many rows only sends its distinct values on. The array of a key is one
    value in one task: use it for columns with few distinct values, and `collect_pages` for others.
    """
    pairs = df.select(key, value).distinct()
    return pairs.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias(name))


def collect_pages(df: DataFrame, keys: Sequence[str], value: str, name: str, page_size: int = 10_000) -> DataFrame:
    """Sorted arrays of the distinct values per key, in pages: keys, `page` (from 0) and an array of at most `page_size` values.

    Distinct values are numbered inside their key by range partitions, so neither a key with very many
    values nor its array meets in one task. NULL values are left out; a key without a value has no page.
    """
    pairs = df.select(*keys, value).where(F.col(value).isNotNull()).distinct()
    placed = positions(pairs, keys, [F.col(value)], "_at")
    page = F.floor(F.col("_at") / F.lit(page_size)).cast("int").alias("page")
    return placed.groupBy(*keys, page).agg(F.sort_array(F.collect_list(value)).alias(name))
