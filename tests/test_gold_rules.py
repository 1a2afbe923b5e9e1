"""Baseline, flags, rates and questions on hand-made rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paylake.operators import account_day as days
from paylake.operators import quarantine
from paylake.operators.merchant_hour import merchant_hour
from paylake.plans import questions
from paylake.rules import Rules

RULES = Rules()


def silver(payments):
    return quarantine.clean(quarantine.classify(quarantine.parse(payments), RULES))


def last(df):
    return df.orderBy(F.desc("account_day")).first()


def test_daily_profile_ignores_null_devices(payments):
    df = silver(
        payments(
            {"device_id": "a", "amount": "1.00"},
            {"device_id": "b", "amount": "7.50"},
            {"device_id": "a"},
            {"device_id": None},
        )
    )
    row = days.daily_profile(df).first()
    assert (row["txns"], row["max_amount"], row["distinct_devices"]) == (4, Decimal("10.00"), 2)


def test_baseline_excludes_the_current_day(daily, day):
    rows = [("A", day(i), "10.00", 1) for i in range(6)] + [("A", day(6), "1000.00", 1)]
    profile = days.with_baseline(daily(*rows), RULES)
    row = last(profile)
    assert row["avg_amount_30d_trailing"] == Decimal("10.000000")
    assert row["prior_txn_count"] == 6
    first = profile.orderBy("account_day").first()
    assert (first["avg_amount_30d_trailing"], first["prior_txn_count"]) == (None, 0)


def test_baseline_counts_active_days_not_calendar_days(daily, day):
    rows = [("A", day(i), "1.00", 1) for i in range(3)] + [("A", day(60), "4.00", 1), ("A", day(300), "8.00", 1)]
    row = last(days.with_baseline(daily(*rows), RULES))
    assert (row["avg_amount_30d_trailing"], row["prior_txn_count"]) == (Decimal("1.750000"), 4)


def test_baseline_looks_back_thirty_rows(daily, day):
    rows = [("A", day(0), "1000.00", 1)] + [("A", day(i), "1.00", 1) for i in range(1, 32)]
    row = last(days.with_baseline(daily(*rows), RULES))
    assert (row["avg_amount_30d_trailing"], row["prior_txn_count"]) == (Decimal("1.000000"), 30)


def test_accounts_do_not_share_a_baseline(daily, day):
    rows = [("A", day(i), "1.00", 1) for i in range(5)] + [("B", day(9), "9.00", 1)]
    assert last(days.with_baseline(daily(*rows), RULES))["prior_txn_count"] == 0


@pytest.mark.parametrize(
    "prior, amount, spike",
    [
        (5, "50.00", True),
        (5, "49.99", False),
        (4, "500.00", False),
        (0, "500.00", False),
    ],
)
def test_spike_threshold(daily, day, prior, amount, spike):
    rows = [("A", day(i), "10.00", 1) for i in range(prior)] + [("A", day(40), amount, 1)]
    flagged = days.with_flags(days.with_baseline(daily(*rows), RULES), RULES)
    assert last(flagged)["is_amount_spike"] is spike


def test_exact_multiple_of_a_repeating_mean_is_a_spike(daily, day):
    amounts = ["0.01", "0.01", "0.01", "0.01", "0.01", "0.02"]
    rows = [("A", day(i), a, 1) for i, a in enumerate(amounts)]
    below = days.with_flags(days.with_baseline(daily(*rows, ("A", day(9), "0.05", 1)), RULES), RULES)
    above = days.with_flags(days.with_baseline(daily(*rows, ("A", day(9), "0.06", 1)), RULES), RULES)
    assert (last(below)["is_amount_spike"], last(above)["is_amount_spike"]) == (False, True)


def test_zero_baseline_is_flagged_without_a_division_error(daily, day):
    rows = [("A", day(i), "0.00", 1) for i in range(5)] + [("A", day(9), "5.00", 1)]
    flagged = days.with_flags(days.with_baseline(daily(*rows), RULES), RULES)
    answer = questions.spend_spikes(flagged).collect()
    assert [(row["max_amount"], row["spike_multiplier"]) for row in answer] == [(Decimal("5.00"), None)]


def test_null_amounts_never_flag(daily, day):
    rows = [("A", day(i), None, None) for i in range(7)]
    row = last(days.with_flags(days.with_baseline(daily(*rows), RULES), RULES))
    assert (row["is_amount_spike"], row["is_device_burst"], row["prior_txn_count"]) == (False, False, 0)


@pytest.mark.parametrize("devices, burst", [(2, False), (3, True)])
def test_burst_threshold(daily, day, devices, burst):
    profile = days.with_baseline(daily(("A", day(0), "1.00", devices)), RULES)
    assert days.with_flags(profile, RULES).first()["is_device_burst"] is burst


def test_null_status_is_not_a_failure(payments):
    df = silver(payments({"status": "FAILED"}, {"status": "SUCCESS"}, {"status": None}))
    row = merchant_hour(df).first()
    assert (row["hour_of_day"], row["txns"], row["failed_txns"], row["failure_rate"]) == (10, 3, 1, 0.3333)


def hours(spark, *rows):
    return spark.createDataFrame(
        rows, "merchant_id string, hour_of_day int, txns long, failed_txns long, failure_rate double"
    )


def test_ratio_of_sums_and_mean_of_rates_differ(spark):
    gold = hours(spark, ("MER0000", 23, 1, 1, 1.0), ("MER0001", 23, 99, 0, 0.0))
    assert questions.offhour_failure(gold, RULES).first()["aggregate_failure_rate_pct"] == 1.0
    assert questions.hourly_failure_curve(gold, RULES).first()["target_grp"] == 50.0


def test_hour_without_one_of_the_groups_has_no_mean(spark):
    row = questions.hourly_failure_curve(hours(spark, ("MER0000", 3, 3, 1, 0.3333)), RULES).first()
    assert (row["target_grp"], row["normal_grp"]) == (pytest.approx(33.33), None)


def test_offhour_groups_windows_and_order(spark):
    gold = hours(
        spark,
        ("MER0039", 0, 4, 1, 0.25),
        ("MER0039", 12, 4, 2, 0.5),
        ("MER0040", 1, 4, 3, 0.75),
        ("MER0040", 2, 0, 0, None),
    )
    rows = [tuple(row) for row in questions.offhour_failure(gold, RULES).collect()]
    assert rows == [
        ("STANDARD_MERCHANTS", "LATE_NIGHT_OFF_HOURS", 4, 3, 75.0),
        ("STANDARD_MERCHANTS", "REGULAR_HOURS", 0, 0, None),
        ("TARGET_HIGH_RISK_GROUP", "LATE_NIGHT_OFF_HOURS", 4, 1, 25.0),
        ("TARGET_HIGH_RISK_GROUP", "REGULAR_HOURS", 4, 2, 50.0),
    ]


def test_audit_labels_name_the_merchant_range():
    labels = questions.audit_labels(RULES)
    assert labels.risk == "TARGET_GROUP (MER0000-MER0039)"
    assert labels.night == "LATE_NIGHT (23,0,1)"


def test_questions_sort_their_answers(daily, day):
    rows = [(a, day(i), "10.00", 1) for a in ("A", "B") for i in range(5)]
    rows += [("A", day(9), "60.00", 4), ("B", day(9), "90.00", 3)]
    gold = days.with_flags(days.with_baseline(daily(*rows), RULES), RULES)
    assert [r["spike_multiplier"] for r in questions.spend_spikes(gold).collect()] == [Decimal("9.00"), Decimal("6.00")]
    assert [r["distinct_devices"] for r in questions.device_bursts(gold).collect()] == [4, 3]


def test_stored_baseline_may_disagree_with_the_flag(spark, daily, day):
    gold = spark.createDataFrame(
        [("A", day(9), Decimal("0.61"), Decimal("0.12"), 5, False)],
        "account_id string, account_day date, max_amount decimal(18,2), "
        "avg_amount_30d_trailing decimal(18,2), prior_txn_count int, is_amount_spike boolean",
    )
    assert questions.spend_spikes_stored(gold, RULES).count() == 1
    assert questions.spend_spikes(gold).count() == 0
