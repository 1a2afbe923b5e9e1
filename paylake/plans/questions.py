"""The business questions, asked of gold tables or of their published views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from paylake.functions.numbers import percent, ratio
from paylake.rules import Rules


def _spike_report(spikes: DataFrame) -> DataFrame:
    amount, baseline = F.col("max_amount"), F.col("avg_amount_30d_trailing")
    ordered = spikes.orderBy(F.desc(F.try_divide(amount, baseline)), "account_id", "account_day")
    return ordered.select(
        "account_id",
        "account_day",
        "max_amount",
        baseline.alias("baseline_30d"),
        ratio(amount, baseline, 2).alias("spike_multiplier"),
        "prior_txn_count",
    )


def spend_spikes(account_days: DataFrame) -> DataFrame:
    """Question 1: account-days flagged as a spending spike, largest multiple first."""
    return _spike_report(account_days.filter("is_amount_spike"))


def spend_spikes_stored(account_days: DataFrame, rules: Rules) -> DataFrame:
    """Question 1 asked of the loaded warehouse table.

    The rule is evaluated again on the stored baseline, which has two decimals, so
    an account-day close to the threshold may differ from the flag.
    """
    rule = (F.col("prior_txn_count") >= rules.min_prior_days) & (
        F.col("max_amount") >= rules.spike_factor * F.col("avg_amount_30d_trailing")
    )
    return _spike_report(account_days.filter(rule))


def device_bursts(account_days: DataFrame) -> DataFrame:
    """Question 2: account-days with many devices."""
    return (
        account_days.filter(F.col("is_device_burst"))
        .orderBy(F.desc("distinct_devices"), F.desc("txns"), "account_id", "account_day")
        .select("account_id", "account_day", "distinct_devices", F.col("txns").alias("total_daily_txns"))
    )


@dataclass(frozen=True)
class OffHourLabels:
    risk: str
    other: str
    night: str
    regular: str


# Row labels of the two published forms of question 3.
WAREHOUSE_LABELS = OffHourLabels(
    risk="TARGET_HIGH_RISK_GROUP",
    other="STANDARD_MERCHANTS",
    night="LATE_NIGHT_OFF_HOURS",
    regular="REGULAR_HOURS",
)


def audit_labels(rules: Rules) -> OffHourLabels:
    return OffHourLabels(
        risk=f"TARGET_GROUP ({rules.risk_merchant_from}-{rules.risk_merchant_to})",
        other="OTHER_MERCHANTS",
        night=f"LATE_NIGHT ({','.join(str(hour) for hour in rules.off_hours)})",
        regular="REGULAR_HOURS",
    )


def in_risk_group(rules: Rules) -> Column:
    """Merchants in the id range; text order, so ids must be zero-padded."""
    return F.col("merchant_id").between(rules.risk_merchant_from, rules.risk_merchant_to)


def offhour_failure(
    merchant_hours: DataFrame, rules: Rules, labels: OffHourLabels = WAREHOUSE_LABELS
) -> DataFrame:
    """Question 3: failures of the risk group and the others, late night and otherwise.

    The percentage is a ratio of sums, so busy hours weigh more.
    """
    group = F.when(in_risk_group(rules), labels.risk).otherwise(labels.other)
    window = F.when(F.col("hour_of_day").isin(*rules.off_hours), labels.night).otherwise(labels.regular)
    return (
        merchant_hours.groupBy(group.alias("merchant_group"), window.alias("time_window"))
        .agg(F.sum("txns").alias("total_txns"), F.sum("failed_txns").alias("total_failed"))
        .withColumn("aggregate_failure_rate_pct", percent(F.col("total_failed"), F.col("total_txns")))
        .orderBy("merchant_group", "time_window")
    )


def hourly_failure_curve(merchant_hours: DataFrame, rules: Rules) -> DataFrame:
    """Mean of the merchants' rates per hour, as percent, for both groups.

    Every merchant weighs the same here, unlike in question 3. Rates have four
    decimals, so they are summed as decimals: the sum does not depend on order.
    """
    rate = F.col("failure_rate").cast("decimal(8,4)")
    risky = in_risk_group(rules)

    def mean_percent(members: Column) -> Column:
        rates = F.when(members, rate)
        return F.try_divide(F.sum(rates).cast("double"), F.count(rates)) * 100

    return (
        merchant_hours.groupBy("hour_of_day")
        .agg(mean_percent(risky).alias("target_grp"), mean_percent(~risky).alias("normal_grp"))
        .orderBy("hour_of_day")
    )


def rejects_by_reason(rejects: DataFrame) -> DataFrame:
    return (
        rejects.groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "reject_reason")
    )
