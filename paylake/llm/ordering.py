"""Global row numbers and running totals without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake.session import scratch_path

# monotonically_increasing_id() keeps the row's place in the low bits, the partition above them.
PLACE_BITS = 33


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back, which cuts its lineage."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(
    spark: SparkSession, df: DataFrame, order: list[str], amount: str | None, label: str
) -> DataFrame:
    """``df`` with ``row_no`` (from 0 in ``order``) and, with an amount, ``before``: its sum over earlier rows.

    Rows are range-partitioned and sorted, so hot values of the order columns spread as
    far as the columns tell rows apart. Only one row per partition is gathered for the
    offsets. Nulls sort first; rows equal in all order columns take any order among them.
    """
    ranged = df.repartitionByRange(*[F.col(name) for name in order]).sortWithinPartitions(*order)
    kept = stored(spark, ranged.withColumn("_place", F.monotonically_increasing_id()), label)
    kept = kept.withColumn("_part", F.shiftright("_place", PLACE_BITS))
    value = F.col(amount) if amount else F.lit(0)
    parts = kept.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(value).cast("long").alias("_sum")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
    )
    joined = kept.join(F.broadcast(starts), "_part")  # one row per partition
    place = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    out = joined.withColumn("row_no", F.col("_first") + place)
    if amount:
        within = (
            Window.partitionBy("_part")
            .orderBy("_place")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        out = out.withColumn(
            "before", F.col("_base") + F.coalesce(F.sum(value).over(within), F.lit(0))
        )
    return out.drop("_part", "_place", "_first", "_base")


# Tables up to this size go to every executor instead of being joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def small_side(df: DataFrame, row_bytes: Column) -> DataFrame:
    """``df``, marked for broadcast if the measured bytes of its rows prove that it is small.

    Beyond ``BROADCAST_BYTES`` Spark plans the join as it likes. ``df`` should be a stored table.
    """
    size = df.agg(F.coalesce(F.sum(row_bytes), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df
