"""Failure rate per merchant and hour of day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paylake.functions.numbers import ratio

# Fixed value: the status that counts as a failure. NULL does not.
FAILED = "FAILED"


def merchant_hour(payments: DataFrame) -> DataFrame:
    counted = payments.groupBy("merchant_id", F.hour("txn_ts").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("txns"),
        F.count_if(F.col("status") == FAILED).alias("failed_txns"),
    )
    return counted.withColumn("failure_rate", ratio(F.col("failed_txns"), F.col("txns"), 4))
