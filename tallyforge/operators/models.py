"""Model training and scoring with Spark ML; the data never leaves Spark."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer, HashingTF, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.operators.evaluation import regression_metrics
from tallyforge.session import file_system, stored

SEED = 42
#: Bins of a column, as many as Spark's trees use by default, and parts of a cell that a tree's bootstrap draws one by one.
BINS = 32
CELL_PARTS = 4
# Feature sets, trees and depth of the two fare models.
FARE_MODELS = {
    "baseline_distance_features": (("trip_distance", "trip_duration_minutes"), 50, 10),
    "enhanced_with_time_features": (
        ("trip_distance", "trip_duration_minutes", "pickup_hour", "pickup_day_of_week", "is_weekend"), 100, 15,
    ),
}


def split_by_key(df: DataFrame, *keys: str, test_tenths: int = 2) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, decided by a hash of the key: the same split on every run."""
    tenth = F.pmod(F.xxhash64(*keys), F.lit(10))
    return df.filter(tenth >= test_tenths), df.filter(tenth < test_tenths)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Per numeric column the cuts of at most `bins` bins, found over all rows: halfway between values where there are few of them, else quantiles.

    A value at a cut lies in the bin above it. At most `bins` - 1 numbers for each column reach the driver.
    """
    points = [i / bins for i in range(1, bins)]
    found = df.agg(
        *[F.approx_count_distinct(c).alias(f"n_{c}") for c in features],
        *[F.percentile_approx(F.col(c).cast("double"), points, 100 * bins).alias(f"q_{c}") for c in features],
    ).first()
    edges = {c: sorted(set(found[f"q_{c}"] or [])) for c in features}
    # The estimate is off by a few per cent; what it lets through is counted exactly.
    for c in features:
        if found[f"n_{c}"] <= 2 * bins:
            values = sorted(r[0] for r in df.select(F.col(c).cast("double")).distinct().limit(bins + 1).collect() if r[0] is not None)
            if len(values) <= bins:
                edges[c] = [(low + high) / 2 for low, high in zip(values, values[1:])]
    return edges


def binned_cells(df: DataFrame, binning: Bucketizer, label: str, parts: int = CELL_PARTS) -> DataFrame:
    """One row for each combination of bins and each of `parts` random parts of its rows: their mean label and their number, `_weight`.

    A tree can't tell rows apart that share all bins, and the gain of a split depends on the sums of labels and the numbers of
    rows on both sides only, so these rows stand for all others, however many there are. The parts are drawn by each tree's
    bootstrap one by one.
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(parts))
    cells = binning.transform(df.withColumn("_part", part)).groupBy(*binning.getOutputCols(), "_part")
    known = F.coalesce(F.col(label), F.raise_error(F.lit("labels must not be NULL")))
    return cells.agg(F.avg(known).alias(label), F.count("*").cast("double").alias("_weight")).drop("_part")


def fit_forest(train: DataFrame, features: Sequence[str], label: str, trees: int, depth: int) -> PipelineModel:
    """Random-forest regression on numeric columns.

    Trees look at binned values only, so all rows are binned and added up to cells first: their number
    is bounded by the bins, and every tree level is a pass over the cells instead of the rows. More
    memory for the split statistics lets one pass serve more tree nodes.
    """
    partitions = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = bin_edges(train, features)
    binning = Bucketizer(
        splitsArray=[[-math.inf, *(edges[c] or [0.0]), math.inf] for c in features], inputCols=list(features), outputCols=[f"_{c}_bin" for c in features]
    )
    cells = stored(binned_cells(train, binning, label).repartition(partitions), "forest-cells")
    forest = Pipeline(
        stages=[
            VectorAssembler(inputCols=binning.getOutputCols(), outputCol="_features"),
            RandomForestRegressor(
                featuresCol="_features", labelCol=label, predictionCol="prediction", weightCol="_weight",
                numTrees=trees, maxDepth=depth, maxBins=BINS, seed=SEED, maxMemoryInMB=1024,
            ),
        ]
    ).fit(cells)
    return PipelineModel(stages=[binning, *forest.stages])


def compare_forests(df: DataFrame, label: str, keys: Sequence[str], models=None) -> DataFrame:
    """Rows (feature_set, rmse, mae, r2) on the test rows, best first. The rows are derived once, for all models."""
    models = models or FARE_MODELS
    used = dict.fromkeys([*keys, label, *(f for features, _, _ in models.values() for f in features)])
    train, test = split_by_key(stored(df.select(*used), "forest-rows"), *keys)
    results = None
    for name, (features, trees, depth) in models.items():
        model = fit_forest(train.select(*keys, *features, label), features, label, trees, depth)
        scores = regression_metrics(model.transform(test), label, "prediction")
        row = scores.select(F.lit(name).alias("feature_set"), "rmse", "mae", "r2")
        results = row if results is None else results.unionByName(row)
    return results.orderBy("rmse", "feature_set")


def fit_text_classifier(train: DataFrame, text: str, label: str, buckets: int = 1 << 14) -> PipelineModel:
    """Binary classifier on hashed words."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"\s+"),
            HashingTF(inputCol="_words", outputCol="_features", numFeatures=buckets, binary=True),
            LogisticRegression(featuresCol="_features", labelCol=label, maxIter=20, regParam=0.05),
        ]
    ).fit(train)


def save_model(model: PipelineModel, path: str) -> None:
    """Write a fitted pipeline to a folder that all executors and later jobs reach, in place of an older one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A pipeline as `save_model` wrote it: it scores batches and streams without being trained again."""
    return PipelineModel.load(path)


def trained_once(spark: SparkSession, path: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
    """The model at `path`; if there is none, `fit` makes it and it is saved there. What is returned was loaded in both cases."""
    system, folder = file_system(spark, f"{path}/metadata")
    if not system.exists(folder):
        save_model(fit(), path)
    return load_model(path)


def score_sentiment(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add `scored`, a struct (label, score): the likelier class and its probability."""
    positive = vector_to_array("probability")[1]
    scored = F.struct(
        F.when(positive >= 0.5, "POSITIVE").otherwise("NEGATIVE").alias("label"),
        F.greatest(positive, 1 - positive).alias("score"),
    )
    return (
        model.transform(df)
        .withColumn("scored", scored)
        .drop("_words", "_features", "rawPrediction", "probability", "prediction")
    )
