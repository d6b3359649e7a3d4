"""Short posts: raw JSON to one row per mention to sentiment per mention."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from tallyforge.functions.text import mentions, without_mentions
from tallyforge.functions.times import parse_feed_time
from tallyforge.plans.steps import STREAM, VIEW, Step
from tallyforge.sources.files import with_lineage
from tallyforge.sources.ingest import stream_json

# The raw fields, all text.
RAW_SCHEMA = "date STRING, user STRING, text STRING, sentiment STRING"


def mention_rows(posts: DataFrame, *also: str) -> DataFrame:
    """One row per mention, lower-cased; a post without one keeps a row with NULL.

    `also` names further columns to keep; `first_of_post`, true in one row of each post, is one that can be asked for.
    """
    rows = posts.select("*", F.posexplode_outer(mentions("text")).alias("_place", "_mention"))
    return rows.withColumn("first_of_post", F.coalesce(F.col("_place") == 0, F.lit(True))).select(
        parse_feed_time("date").alias("timestamp"),
        F.lower("_mention").alias("mention"),
        without_mentions("text").alias("cleaned_text"),
        "text",
        "sentiment",
        *also,
    )


def with_sentiment_ids(scored: DataFrame) -> DataFrame:
    """Unpack struct `scored` (label, score): lower-cased label, score in %, binary ids.

    The known sentiment '0' and the predicted 'negative' map to 0, anything else,
    NULL included, to 1.
    """
    return (
        scored.withColumn("predicted_score", F.col("scored.score") * 100)
        .withColumn("predicted_sentiment", F.lower("scored.label"))
        .withColumn("sentiment_id", F.when(F.col("sentiment") == "0", 0).otherwise(1))
        .withColumn("predicted_sentiment_id", F.when(F.col("predicted_sentiment") == "negative", 0).otherwise(1))
        .drop("scored")
    )


def sentiment_by_mention(posts: DataFrame) -> DataFrame:
    """Positive, negative and total posts with first and last time, per mention."""
    positive = F.count_if(F.col("predicted_sentiment") == "positive")
    negative = F.count_if(F.col("predicted_sentiment") == "negative")
    return (
        posts.filter("mention IS NOT NULL")
        .groupBy("mention")
        .agg(
            positive.alias("positive"),
            negative.alias("negative"),
            (positive + negative).alias("total"),
            F.min("timestamp").alias("min_timestamp"),
            F.max("timestamp").alias("max_timestamp"),
        )
    )


def counters(posts: DataFrame) -> DataFrame:
    """Rows (metric, value): posts, mention rows with and without a mention, counted in one pass."""
    found = F.size(mentions("text"))
    counts = posts.agg(
        F.count("*").alias("total_posts"),
        F.coalesce(F.sum(F.greatest(found, F.lit(0))), F.lit(0)).alias("with_mentions"),
        F.count_if(F.coalesce(found, F.lit(0)) <= 0).alias("without_mentions"),
    )
    return counts.unpivot([], counts.columns, "metric", "value")


def top_lists(rows: DataFrame, k: int = 10) -> DataFrame:
    """Rows (list, label, value): the k most frequent users, and mentions by positive and by negative posts.

    `rows` are mention rows with `user`, `first_of_post` and `predicted_sentiment`. One pass; ties broken by the label.
    """
    entries = [
        ("users", "user", F.col("first_of_post")),
        *[(kind, "mention", F.col("predicted_sentiment") == kind) for kind in ("positive", "negative")],
    ]
    each = F.array(*[
        F.struct(F.lit(name).alias("list"), F.col(label).alias("label"), F.coalesce(counts, F.lit(False)).cast("long").alias("n"))
        for name, label, counts in entries
    ])
    sums = rows.select(F.explode(each).alias("e")).select("e.*").groupBy("list", "label").agg(F.sum("n").alias("value"))
    listed = sums.filter("list = 'users' OR label IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("list").orderBy(F.desc("value"), "label"))
    return listed.withColumn("place", place).filter(F.col("place") <= k).drop("place")


def flow(source: str, score: Callable[[DataFrame], DataFrame]) -> list[Step]:
    """`score` adds struct `scored` (label, score) from cleaned_text."""
    return [
        Step("posts_bronze", STREAM, lambda spark, read: with_lineage(stream_json(spark, source, RAW_SCHEMA))),
        Step("posts_silver", STREAM, lambda spark, read: mention_rows(read("posts_bronze", stream=True))),
        Step("posts_gold", STREAM,
             lambda spark, read: with_sentiment_ids(score(read("posts_silver", stream=True)))),
        Step("sentiment_by_mention", VIEW, lambda spark, read: sentiment_by_mention(read("posts_gold"))),
    ]
