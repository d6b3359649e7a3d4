"""Functions a user can call from SQL, and the way to add Python ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession, functions as F, types as T

# SQL bodies: Spark inlines them, so no Python worker is involved.
SQL_FUNCTIONS = {
    "categorize_age(age DOUBLE)": "STRING RETURN CASE WHEN age < 25 THEN 'Young Adult' WHEN age < 35 THEN 'Adult' "
    "WHEN age < 50 THEN 'Middle Age' ELSE 'Senior' END",
    "calculate_discount(amount DOUBLE)": "DOUBLE RETURN amount * CASE WHEN amount >= 200 THEN 0.15D "
    "WHEN amount >= 100 THEN 0.10D ELSE 0.05D END",
    "loyalty_points(cnt BIGINT, total DOUBLE, mean DOUBLE)": "INT RETURN CAST(least(cnt * 10, 40) "
    "+ least(total / 10, 40D) + least(mean / 10, 20D) AS INT)",
}


def register_sql_functions(spark: SparkSession) -> None:
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {body}")


def register_python(spark: SparkSession, name: str, function: Callable, returns: T.DataType | str):
    """Register a Python function for SQL and DataFrames, with Arrow transfer.

    The extension point for logic Spark's functions cannot express; NULL is the
    function's own business.
    """
    return spark.udf.register(name, F.udf(function, returnType=returns, useArrow=True))
