"""Collects the queries by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyforge.workload.standins import Tables, sql_with


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, needs: str = ""):
    """Register a function of `Tables`. `sql` checks it; `needs` lists the derived tables the SQL uses."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(name, build, sql_with(sql, *needs.split()) if sql else None)
        return build

    return register


def r(value: Column | str, digits: int = 2) -> Column:
    """Rounded, as sums of doubles depend on their order in the last bits."""
    return F.round(value, digits)


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """The DataFrame with some columns rounded."""
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


def stamp(ts: Column | str) -> Column:
    """A time as text, so that engines agree on its look."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day(date: Column | str) -> Column:
    return F.date_format(date, "yyyy-MM-dd")
