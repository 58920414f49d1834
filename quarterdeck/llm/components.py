"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.workspace import written

# Rows up to which a written side of a join is broadcast.
BROADCAST_ROWS = 100_000


def small_or_whole(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, marked for broadcast if it has at most ``rows`` rows; otherwise Spark deals out
    both sides of the join and may split a frequent key."""
    return F.broadcast(df) if df.count() <= rows else df


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long): the smallest node reachable.

    Each round links neighbours above a node to the smallest one near it, then those below; rounds
    grow with the logarithm of the longest path. Every round is written, and no step sees more of a
    node's neighbours in one row than two.
    """
    spark = edges.sparkSession
    links = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            ) if state[0] else spark.createDataFrame([], "node long, component long")
        before = state
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m")), "large-star")
        large = written(
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(),
            "large",
        )
        below = written(large.groupBy("a").agg(F.min("b").alias("m")), "small-star")
        links = written(
            large.join(below, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(below.select("a", F.col("m").alias("b")))
            .distinct(),
            "links",
        )
