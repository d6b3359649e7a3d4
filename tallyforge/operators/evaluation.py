"""Scores of predictions against known answers, computed on Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyforge.operators.aggregates import percentiles
from tallyforge.operators.totals import with_totals
from tallyforge.session import stored


def confusion_matrix(df: DataFrame, truth: str, predicted: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Rows (truth, predicted, count) for every pair of classes, 0 where none occurs."""
    grid = df.sparkSession.createDataFrame(
        [(t, p) for t in classes for p in classes], f"{truth} int, {predicted} int"
    )
    counts = df.groupBy(truth, predicted).agg(F.count("*").alias("count"))
    return grid.join(counts, [truth, predicted], "left").select(
        truth, predicted, F.coalesce("count", F.lit(0)).alias("count")
    )


def classification_report(df: DataFrame, truth: str, predicted: str, names: Sequence[str]) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Class i is called names[i]. The data is read once: the count per pair of classes is
    written, and the rest works on those few rows.
    """
    matrix = confusion_matrix(df, truth, predicted, range(len(names)))
    cells = stored(matrix, "confusion")
    per_class = cells.groupBy(F.col(truth).alias("class")).agg(
        F.sum("count").alias("support"),
        F.sum(F.when(F.col(truth) == F.col(predicted), F.col("count")).otherwise(0)).alias("hits"),
    )
    guessed = cells.groupBy(F.col(predicted).alias("class")).agg(F.sum("count").alias("guesses"))
    scored = (
        per_class.join(guessed, "class")
        .withColumn("precision", F.coalesce(F.try_divide("hits", "guesses"), F.lit(0.0)))
        .withColumn("recall", F.coalesce(F.try_divide("hits", "support"), F.lit(0.0)))
        .withColumn(
            "f1_score",
            F.coalesce(
                F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                F.lit(0.0),
            ),
        )
    )
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("class") + 1)
    support = F.sum("support")

    def weighted(column: str):
        return F.try_divide(F.sum(F.col(column) * F.col("support")), support)

    accuracy = F.try_divide(F.sum("hits"), support)
    measures = ("precision", "recall", "f1_score")
    classes = scored.select(label.alias("label"), *measures, "support")
    overall = scored.agg(
        F.lit("accuracy").alias("label"),
        accuracy.alias("precision"), accuracy.alias("recall"), accuracy.alias("f1_score"),
        support.alias("support"),
    )
    macro = scored.agg(
        F.lit("macro avg").alias("label"), *[F.avg(m).alias(m) for m in measures], support.alias("support")
    )
    by_support = scored.agg(
        F.lit("weighted avg").alias("label"), *[weighted(m).alias(m) for m in measures], support.alias("support")
    )
    return classes.unionByName(overall).unionByName(macro).unionByName(by_support)


def regression_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: rmse, mae, r2."""
    error = F.col(predicted) - F.col(truth)
    return df.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(truth) * F.count(truth))).alias("r2"),
    )


def with_errors(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Signed, absolute and percentage error columns."""
    return (
        df.withColumn("prediction_error", F.col(predicted) - F.col(truth))
        .withColumn("absolute_error", F.abs("prediction_error"))
        .withColumn("percentage_error", F.try_divide("absolute_error", truth) * 100)
    )


def error_distribution(df: DataFrame, *keys: str) -> DataFrame:
    """Mean, deviation, median, 95th percentile and count on the columns of `with_errors`, per key if given."""
    return df.groupBy(*keys).agg(
        F.avg("absolute_error").alias("mean_absolute_error"),
        F.stddev("absolute_error").alias("std_absolute_error"),
        F.avg("percentage_error").alias("mean_percentage_error"),
        *percentiles("absolute_error", (0.5, 0.95), ("median_absolute_error", "p95_absolute_error")),
        F.count("*").alias("total_predictions"),
    )


def flag_outliers_iqr(df: DataFrame, column: str) -> DataFrame:
    """is_outlier: more than 1.5 interquartile ranges outside the quartiles of the whole table."""
    quartiles = df.agg(*percentiles(column, (0.25, 0.75), ("_q1", "_q3")))
    margin = 1.5 * (F.col("_q3") - F.col("_q1"))
    outside = (F.col(column) < F.col("_q1") - margin) | (F.col(column) > F.col("_q3") + margin)
    return with_totals(df, quartiles).withColumn("is_outlier", outside).drop("_q1", "_q3")


def flag_outliers_zscore(df: DataFrame, column: str, limit: float = 3.0) -> DataFrame:
    """z_score against the whole table, and is_outlier when it exceeds `limit`."""
    moments = df.agg(F.avg(column).alias("_mean"), F.stddev(column).alias("_sd"))
    return (
        with_totals(df, moments)
        .withColumn("z_score", F.try_divide(F.abs(F.col(column) - F.col("_mean")), F.col("_sd")))
        .withColumn("is_outlier", F.col("z_score") > limit)
        .drop("_mean", "_sd")
    )
