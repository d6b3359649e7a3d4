"""Data-quality profiles and repairs. Each profile is one pass, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyforge.operators.aggregates import ACCURACY
from tallyforge.operators.totals import with_totals

# The address check and the age limits.
EMAIL_PATTERN = r"^[\w\.-]+@[\w\.-]+\.\w+$"
YOUNGEST, OLDEST = 18, 120

# What a missing category becomes.
MISSING_CATEGORY = {
    "state": "Unknown",
    "category": "General",
    "payment_method": "Unknown",
    "gender": "Unknown",
}
MEDIAN_FILLED = ("age", "amount")


def _is_missing(field: T.StructField) -> Column:
    absent = F.col(field.name).isNull()
    if isinstance(field.dataType, T.StringType):
        absent = absent | (F.col(field.name) == "")
    return absent


def missing_values(df: DataFrame) -> DataFrame:
    """Rows (column, missing, missing_pct); an empty string counts as missing."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(_is_missing(field)).alias(field.name) for field in df.schema.fields],
    )
    return counts.unpivot("_rows", df.columns, "column", "missing").select(
        "column",
        "missing",
        F.coalesce(F.try_divide(F.col("missing") * 100.0, "_rows"), F.lit(0.0)).alias("missing_pct"),
    )


def schema_differences(df: DataFrame, expected: T.StructType) -> list[str]:
    """Missing columns, extra columns and type mismatches, as sentences. Reads no data."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in expected.fields}
    issues = [f"Missing column: {name}" for name in wanted if name not in actual]
    issues += [f"Extra column: {name}" for name in actual if name not in wanted]
    issues += [
        f"Type mismatch for {name}: expected {wanted[name].simpleString()}, got {actual[name].simpleString()}"
        for name in wanted
        if name in actual and actual[name] != wanted[name]
    ]
    return issues


def uncastable_values(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Rows (column, uncastable): values that are present but do not fit the expected type."""
    shared = [f for f in expected.fields if f.name in df.columns]
    counts = df.agg(
        *[
            F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
            for f in shared
        ]
    )
    return counts.unpivot([], [f.name for f in shared], "column", "uncastable")


def standardise(df: DataFrame) -> DataFrame:
    """Add a cleaned twin for each of the columns email, name, phone, state that exists."""
    cleaned = {
        "email": ("email_clean", F.lower(F.trim("email"))),
        "name": ("name_standardized", F.initcap(F.trim("name"))),
        "phone": ("phone_clean", F.regexp_replace("phone", "[^0-9]", "")),
        "state": ("state_code", F.upper(F.trim("state"))),
    }
    return df.withColumns({new: value for old, (new, value) in cleaned.items() if old in df.columns})


def fill_missing(df: DataFrame, strategy: str = "smart") -> DataFrame:
    """smart: medians and named categories; drop: drop rows with a NULL; zero: 0; other: 'Unknown'."""
    if strategy == "drop":
        return df.dropna()
    if strategy == "zero":
        return df.fillna(0)
    if strategy != "smart":
        return df.fillna("Unknown")
    numeric = [f.name for f in df.schema.fields
               if f.name in MEDIAN_FILLED and isinstance(f.dataType, T.NumericType)]
    if numeric:
        medians = df.agg(
            *[F.percentile_approx(c, 0.5, ACCURACY).alias(f"_median_{c}") for c in numeric]
        )
        df = with_totals(df, medians).withColumns(
            {c: F.coalesce(c, f"_median_{c}") for c in numeric}
        ).drop(*medians.columns)
    return df.fillna({c: v for c, v in MISSING_CATEGORY.items() if c in df.columns})


def rule_violations(df: DataFrame, as_of: Column) -> DataFrame:
    """Rows (rule, violations) for the rules whose column exists. `as_of` is the day called today."""
    rules = {
        "amount": ("Negative amounts", F.col("amount") < 0) if "amount" in df.columns else None,
        "age": ("Invalid ages", ~F.col("age").between(YOUNGEST, OLDEST)) if "age" in df.columns else None,
        "transaction_date": ("Future dates", F.col("transaction_date") > as_of)
        if "transaction_date" in df.columns else None,
        "email": ("Invalid emails", ~F.col("email").rlike(EMAIL_PATTERN)) if "email" in df.columns else None,
    }
    present = [rule for rule in rules.values() if rule]
    return label_counts(df, dict(present))


def label_counts(df: DataFrame, issues: Mapping[str, Column], label: str = "rule", count: str = "violations") -> DataFrame:
    """Rows (label, count): how many rows meet each named condition, counted in one pass."""
    names = list(issues)
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in issues.items()])
    return counts.unpivot([], names, label, count)


def quality_report(df: DataFrame, name: str, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, columns, missing values, duplicates on `keys` (all columns by default), completeness in %."""
    profile = df.agg(
        F.count("*").alias("total_rows"),
        sum((F.count_if(_is_missing(f)) for f in df.schema.fields), F.lit(0)).alias("missing_values"),
    )
    groups = df.groupBy(*(keys or df.columns)).agg(F.count("*").alias("n"))
    duplicates = groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    cells = F.col("total_rows") * len(df.columns)
    return with_totals(profile, duplicates).select(
        F.lit(name).alias("dataset"),
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        "missing_values",
        "duplicates",
        ((1 - F.try_divide("missing_values", cells)) * 100).alias("completeness_pct"),
    )
