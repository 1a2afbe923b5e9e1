"""Connected components by alternating star contractions, each round written to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm.ordering import stored


def _large_star(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Link the neighbours above each node to the smallest of its neighbours and itself."""
    around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # Written first: a node with very many neighbours is split by AQE, which needs both
    # sides of the join straight from a shuffle.
    least = stored(spark, least, "least")
    return around.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the neighbours below each node, and the node, to the smallest of them.

    Edges point from the smaller to the larger node.
    """
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    moved = joined.select(F.col("m").alias("a"), "b").union(
        joined.where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    )
    return moved.distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b); the root is the smallest node reachable.

    Rounds are logarithmic in the longest chain in practice. Minima are combined before their
    shuffles. Only one count and one checksum per round reach the driver.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = stored(spark, pairs.where("a < b").distinct(), "links")
    seen = None
    while True:
        now = stored(spark, _small_star(_large_star(spark, now)), "links")
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    # Every remaining link goes from a root to a node of its component.
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
