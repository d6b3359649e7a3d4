"""Connected components by joins, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyforge.session import remove, shared_dir


def _stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The DataFrame written and read back, and its folder."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Each node of an undirected graph, with the smallest node it can reach.

    `edges` has two columns of comparable values; loops, repeats and nulls are allowed (an edge with a
    null is ignored). Result: `node`, `root`, one row for each node that has an edge to another node.
    Alternates two steps: each node links its larger neighbours, then its smaller ones, to the smallest
    neighbour. Trees become stars in a few rounds. Every round is written to the shared folder, and the one before
    is removed from it. The minima
    are aggregated before the join, so a node with very many neighbours is one row of one side, and
    adaptive skew handling can split the other.
    """
    a, b = edges.columns
    spark = edges.sparkSession
    now, folder = _stored(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b")))
        .distinct(),
        "edges",
    )
    before = None
    state = _state(now)
    while state != before and state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _smallest(both).withColumn("m", F.least("a", "m"))
        # To each larger neighbour, and to the node itself.
        large, between = _stored(
            both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.where("a != m").select("a", F.col("m").alias("b"))).distinct(),
            "large-star",
        )
        least = _smallest(large)
        now, after = _stored(
            large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct(),
            "small-star",
        )
        before, state = state, _state(now)
        remove(spark, folder)
        remove(spark, between)
        folder = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
