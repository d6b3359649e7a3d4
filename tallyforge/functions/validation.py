"""Checks on single values and on small text records, as columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.operators.quality import EMAIL_PATTERN


def doubled(value: str, default: int = 0) -> Column:
    """Twice the value as an int; `default` when it is NULL, not a number, or too large."""
    return F.coalesce(F.try_multiply(F.col(value).try_cast("int"), F.lit(2)), F.lit(default))


def _verdict(valid: Column, error: Column, cleansed: Column) -> Column:
    return F.struct(
        F.coalesce(valid, F.lit(False)).alias("is_valid"),
        F.coalesce(error, F.lit("")).alias("validation_errors"),
        cleansed.alias("cleansed_value"),
    )


def _email(value: Column, raw: Column) -> Column:
    has_at = value.isNotNull() & value.contains("@")
    cleaned = F.trim(F.lower(value))
    fits = cleaned.rlike(EMAIL_PATTERN)
    error = F.when(~has_at, "Invalid email format").when(~fits, "Invalid email pattern")
    return _verdict(has_at & fits, error, F.when(has_at, cleaned).otherwise(raw))


def _phone(value: Column, raw: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    local = F.when(F.length(digits) == 10, digits).when(
        (F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)
    )
    pretty = F.concat(
        F.lit("("), F.substring(local, 1, 3), F.lit(") "),
        F.substring(local, 4, 3), F.lit("-"), F.substring(local, 7, 4),
    )
    error = F.when(value.isNull(), "Missing phone number").when(local.isNull(), "Invalid phone number length")
    return _verdict(local.isNotNull(), error, F.coalesce(pretty, raw))


def _currency(value: Column, raw: Column) -> Column:
    number = F.regexp_replace(value, "[^0-9.-]", "").try_cast("double").try_cast("decimal(38,2)")
    pretty = F.concat(F.lit("$"), number.cast("string"))
    # A negative amount is reported but stays valid.
    error = (
        F.when(value.isNull(), "Missing currency value")
        .when(number.isNull(), "Invalid currency format")
        .when(number < 0, "Negative currency value")
    )
    return _verdict(number.isNotNull(), error, F.coalesce(pretty, raw))


# Accepted spellings of a date, tried in order.
DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy", "d-M-yyyy")


def _date(value: Column, raw: Column) -> Column:
    parsed = F.coalesce(*[F.try_to_timestamp(value, F.lit(fmt)) for fmt in DATE_FORMATS])
    error = F.when(value.isNull(), "Missing date").when(parsed.isNull(), "Invalid date format")
    return _verdict(parsed.isNotNull(), error, F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), raw))


def validated(value: str, kind: str) -> Column:
    """struct(is_valid, validation_errors, cleansed_value) for kinds email, phone, currency, date.

    A value of any other kind is valid and stays as it is.
    """
    v, k = F.col(value), F.col(kind)
    raw = F.coalesce(v, F.lit(""))
    return (
        F.when(k == "email", _email(v, raw))
        .when(k == "phone", _phone(v, raw))
        .when(k == "currency", _currency(v, raw))
        .when(k == "date", _date(v, raw))
        .otherwise(_verdict(F.lit(True), F.lit(""), raw))
    )


def apply_rules(df: DataFrame, record: str, rules: Mapping[str, str]) -> DataFrame:
    """Check texts like 'age=25|amount=500|state=CA' against named SQL conditions on the map `fields`.

    Adds passed, failed, failed_rules and status: APPROVED without a failure,
    REVIEW up to two, else REJECTED. A condition that is NULL counts as failed. Of a
    repeated field the last value counts.
    """
    parts = F.transform(F.split(F.coalesce(F.col(record), F.lit("")), r"\|"), lambda part: F.split(part, "=", 2))
    # By name, the last first: then the first of each name is the one that counts.
    entries = F.array_sort(F.transform(parts, lambda pair, i: F.struct(pair[0].alias("name"), (-i).alias("back"), F.get(pair, F.lit(1)).alias("value"))))
    is_new = lambda entry, i: (i == 0) | (F.get("_entries", i - 1)["name"] != entry["name"])
    checked = df.withColumn("_entries", entries).withColumn("fields", F.map_from_entries(F.transform(
        F.filter("_entries", is_new), lambda entry: F.struct(entry["name"], entry["value"]),
    ))).drop("_entries")
    failures = F.array_compact(
        F.array(
            *[F.when(~F.coalesce(F.expr(condition), F.lit(False)), name) for name, condition in rules.items()]
        )
    )
    failed = F.size("_failures")
    return (
        checked.withColumn("_failures", failures)
        .withColumns(
            {
                "passed": F.lit(len(rules)) - failed,
                "failed": failed,
                "failed_rules": F.concat_ws("|", "_failures"),
                "status": F.when(failed == 0, "APPROVED").when(failed <= 2, "REVIEW").otherwise("REJECTED"),
            }
        )
        .drop("fields", "_failures")
    )


def _number(name: str) -> str:
    return f"coalesce(try_cast(fields['{name}'] AS double), 0)"


# The customer rules; a missing field reads as 0 or as an empty text.
CUSTOMER_RULES = {
    "min_age": f"{_number('age')} >= 18",
    "max_transaction": f"{_number('amount')} <= 10000",
    "valid_state": "coalesce(fields['state'], '') IN ('CA', 'NY', 'TX', 'FL', 'WA', 'IL')",
    "positive_balance": f"{_number('balance')} >= 0",
}


def series_shape(df: DataFrame, key: str, series: str) -> DataFrame:
    """Seasonality (deviation / mean), trend and volatility of a comma list of numbers per key.

    The trend follows the slope over the positions: above 5 increasing, below -5
    decreasing, else stable. Fewer than 3 numbers, or a text that is not all
    numbers, give 0, stable, 0.
    """
    raw = F.filter(F.split(F.coalesce(F.col(series), F.lit("")), ","), lambda p: F.trim(p) != "")
    points = df.select(key, F.posexplode_outer(raw).alias("x", "y")).select(
        key, "x", F.col("y").try_cast("double").alias("v"), F.col("y").isNotNull().alias("given")
    )
    shaped = points.groupBy(key).agg(
        F.count("v").alias("n"),
        F.count_if(F.col("given") & F.col("v").isNull()).alias("broken"),
        F.avg("v").alias("mean"),
        F.stddev_pop("v").alias("sd"),
        # Least squares from plain sums: exact for whole numbers, in whatever order they come.
        F.try_divide(
            F.count("v") * F.sum(F.col("x") * F.col("v")) - F.sum("x") * F.sum("v"),
            F.count("v") * F.sum(F.col("x") * F.col("x")) - F.sum("x") * F.sum("x"),
        ).alias("slope"),
    )
    usable = (F.col("n") >= 3) & (F.col("broken") == 0)
    seasonality = F.when(usable & (F.col("mean") > 0), F.col("sd") / F.col("mean")).otherwise(0.0)
    trend = (
        F.when(usable & (F.col("slope") > 5), "increasing")
        .when(usable & (F.col("slope") < -5), "decreasing")
        .otherwise("stable")
    )
    return shaped.select(
        key, seasonality.alias("seasonality_index"), trend.alias("trend_direction"),
        seasonality.alias("volatility_score"),
    )
