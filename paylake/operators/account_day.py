"""Account-day profile, trailing baseline and the two account flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from paylake.rules import Rules


def daily_profile(payments: DataFrame) -> DataFrame:
    """Rows, largest amount and exact distinct devices per account and day.

    Spark plans the distinct count in two steps: first per (account, day, device)
    with map-side partials, then per (account, day). A hot account is therefore
    reduced before each shuffle and spread over its days and devices.
    """
    return payments.groupBy("account_id", "account_day").agg(
        F.count(F.lit(1)).alias("txns"),
        F.max("amount").alias("max_amount"),
        F.count_distinct("device_id").alias("distinct_devices"),
    )


def with_baseline(daily: DataFrame, rules: Rules) -> DataFrame:
    """Add the mean and count of the prior active days, the current day excluded.

    The frame counts rows, so it spans the last active days, however far apart.
    One account has at most one row per calendar day here, which bounds the
    partition of a single account.
    """
    prior = (
        Window.partitionBy("account_id")
        .orderBy("account_day")
        .rowsBetween(-rules.baseline_days, -1)
    )
    return daily.withColumns(
        {
            "avg_amount_30d_trailing": F.avg("max_amount").over(prior),
            "prior_txn_count": F.count("max_amount").over(prior),
        }
    )


def with_flags(profile: DataFrame, rules: Rules) -> DataFrame:
    """Add both flags; a NULL test counts as False.

    The spike test uses the unrounded decimal baseline.
    """
    spike = (F.col("prior_txn_count") >= rules.min_prior_days) & (
        F.col("max_amount") >= rules.spike_factor * F.col("avg_amount_30d_trailing")
    )
    burst = F.col("distinct_devices") >= rules.burst_devices
    return profile.withColumns(
        {
            "is_amount_spike": F.coalesce(spike, F.lit(False)),
            "is_device_burst": F.coalesce(burst, F.lit(False)),
        }
    )


def account_day(payments: DataFrame, rules: Rules) -> DataFrame:
    return with_flags(with_baseline(daily_profile(payments), rules), rules)
