"""Models trained and applied on Spark."""

from pyspark.sql import functions as F

from tallyforge.operators import evaluation, models
from tallyforge.plans import posts, taxi
from tallyforge.session import shared_dir
from tallyforge.workload.registry import query
from tallyforge.workload.reports import MENTION_ROWS


def features(t):
    """Valid trips with a fare that distance and time explain in part: the prices of the test table, which they don't explain at all, are the rest."""
    key = F.xxhash64("pickup_at", "pickup_zip", "dropoff_zip", "fare_amount")
    trips = taxi.valid_features(taxi.with_features(t.taxi)).withColumn("trip_key", key)
    metered = 3 + 2.5 * F.col("trip_distance") + 0.5 * F.col("trip_duration_minutes")
    return trips.withColumn("fare_amount", metered + F.col("fare_amount") / 2000)


# The error of the mean over all trips, which a model has to beat.
MEAN_ERROR = """
    SELECT round(stddev_pop(3 + 2.5 * trip_distance + 0.5 * m + fare_amount / 2000), 4)::DOUBLE AS mean_error
    FROM (SELECT *, (epoch(dropoff_at) - epoch(pickup_at)) / 60.0 AS m FROM taxi)
    WHERE fare_amount > 0 AND trip_distance > 0 AND m > 0 AND trip_distance / (m / 60.0) > 0 AND trip_distance / (m / 60.0) < 80
"""


@query("ml01_split", "SELECT count(*) AS row_count, 0::BIGINT AS in_both, true AS a_fifth_tested FROM orders")
def split(t):
    """Every row is in one part, and about a fifth is kept for the test."""
    train, test = models.split_by_key(t.orders.select("o_orderkey"), "o_orderkey")
    parts = train.withColumn("tested", F.lit(0)).unionByName(test.withColumn("tested", F.lit(1)))
    per_key = parts.groupBy("o_orderkey").agg(F.count("*").alias("n"), F.count_distinct("tested").alias("parts"), F.max("tested").alias("tested"))
    return per_key.agg(
        F.sum("n").alias("row_count"), F.count_if(F.col("parts") > 1).alias("in_both"), F.avg("tested").between(0.15, 0.25).alias("a_fifth_tested")
    )


def against_the_mean(t, sets):
    """Each model's error on its test rows against that of the mean; a part of the fare must stay unexplained, or the test were no test."""
    trips = features(t)
    mean = trips.agg(F.round(F.stddev_pop("fare_amount"), 4).alias("mean_error"))
    scores = models.compare_forests(trips, "fare_amount", ["trip_key"], sets)
    error = F.col("mean_error")
    return scores.withColumn("mean_error", mean.scalar()).select(
        "feature_set", error, (F.col("rmse") < 0.9 * error).alias("beats_the_mean"), (F.col("rmse") > 0.2 * error).alias("some_unexplained"),
        (F.col("mae") <= F.col("rmse")).alias("errors_agree"),
    )


FARE_SQL = f"""SELECT feature_set, mean_error, true AS beats_the_mean, true AS some_unexplained, true AS errors_agree
               FROM (VALUES %s) v(feature_set) CROSS JOIN ({MEAN_ERROR})"""


@query("ml02_fare_model", FARE_SQL % "('baseline_distance_features')", "taxi")
def fare_model(t):
    name = "baseline_distance_features"
    return against_the_mean(t, {name: models.FARE_MODELS[name]})


@query(
    "ml03_text_classifier",
    """SELECT label, true AS within_bounds FROM (VALUES ('Negative'), ('Positive'), ('accuracy'), ('macro avg'), ('weighted avg')) v(label)""",
)
def text_classifier(t):
    labelled = t.documents.join(t.labels, "doc_id").select("doc_id", "text", "quality")
    train, test = models.split_by_key(labelled, "doc_id")
    model = models.fit_text_classifier(train, "text", "quality")
    scored = models.score_sentiment(model, test).withColumn(
        "predicted", F.when(F.col("scored.label") == "POSITIVE", 1).otherwise(0)
    )
    report = evaluation.classification_report(scored, "quality", "predicted", ["Negative", "Positive"])
    shares = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1_score")]
    # Better than a coin over all test rows.
    useful = (F.col("label") != "accuracy") | (F.col("precision") > 0.5)
    return report.select("label", (shares[0] & shares[1] & shares[2] & useful).alias("within_bounds"))


@query("ml04_ranked_models", FARE_SQL % "('baseline_distance_features'), ('enhanced_with_time_features')", "taxi")
def ranked_models(t):
    return against_the_mean(t, models.FARE_MODELS)


@query(
    "ud19_scored_posts",
    f"SELECT count(*) AS row_count, true AS scores_in_range, true AS ids_follow_labels, true AS same_when_loaded FROM ({MENTION_ROWS})",
    "posts",
)
def scored_posts(t):
    """Scores by a model that was trained once, saved and loaded; next to them those of the model before it was saved."""
    labelled = t.documents.join(t.labels, "doc_id").select("text", "quality")
    path = f"{shared_dir(t.spark, 'models')}/sentiment"
    fitted = models.fit_text_classifier(labelled.withColumnRenamed("text", "cleaned_text"), "cleaned_text", "quality")
    loaded = models.trained_once(t.spark, path, lambda: fitted)
    before = models.score_sentiment(fitted, posts.mention_rows(t.posts)).withColumnRenamed("scored", "scored_before")
    scored = models.score_sentiment(loaded, before).withColumn("same", F.col("scored") == F.col("scored_before"))
    known = posts.with_sentiment_ids(scored)
    fits = F.col("predicted_sentiment_id") == F.when(F.col("predicted_sentiment") == "negative", 0).otherwise(1)
    return known.agg(
        F.count("*").alias("row_count"), F.every(F.col("predicted_score").between(50, 100)).alias("scores_in_range"), F.every(fits).alias("ids_follow_labels"),
        F.every("same").alias("same_when_loaded"),
    )
