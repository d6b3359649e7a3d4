"""Row expectations: named SQL conditions a row must meet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def _holds(condition: str) -> Column:
    # A condition that is NULL counts as not met.
    return F.coalesce(F.expr(condition), F.lit(False))


def keep_expected(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep the rows that meet every rule. Works on streams."""
    for condition in rules.values():
        df = df.filter(_holds(condition))
    return df


def count_failures(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows (rule, failures): one pass over `df` counts all rules."""
    counts = df.agg(
        *[F.count_if(~_holds(condition)).alias(rule) for rule, condition in rules.items()]
    )
    return counts.unpivot([], list(rules), "rule", "failures")


def observe_failures(df: DataFrame, rules: Mapping[str, str], name: str = "expectations") -> DataFrame:
    """Report the failure counts as observed metrics of the running query, batch or stream."""
    return df.observe(
        name, *[F.count_if(~_holds(condition)).alias(rule) for rule, condition in rules.items()]
    )
