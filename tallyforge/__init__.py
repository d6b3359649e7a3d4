"""Reusable Spark data jobs: cleaning, joining, ranking, merging, streaming and reporting.

Every operator takes DataFrames and returns a DataFrame, so it can be used with
``DataFrame.transform``. Nothing here wraps DataFrame or replaces ``spark.sql``.
"""
