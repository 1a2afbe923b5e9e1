"""Masks by role, by-name loads and constraint audits."""

from datetime import date
from decimal import Decimal

from paylake.operators.governance import (
    ANALYST_ROLE,
    CLEAR_ROLE,
    audit_constraints,
    conform,
    masked_view,
)
from paylake.schemas import WAREHOUSE_ACCOUNT_DAY, WAREHOUSE_MERCHANT_HOUR, WAREHOUSE_REJECTS


def gold(spark, *rows):
    """Account days in the order the gold job writes them, not the declared order."""
    return spark.createDataFrame(
        rows,
        "account_id string, account_day date, txns long, max_amount decimal(18,2), distinct_devices long, "
        "avg_amount_30d_trailing decimal(22,6), prior_txn_count long, is_amount_spike boolean, "
        "is_device_burst boolean",
    )


ROW = ("ACC00000123", date(2025, 5, 2), 4, Decimal("9.00"), 3, Decimal("1.005000"), 7, False, True)


def test_only_the_clear_role_sees_ids(spark):
    df = gold(spark, ROW)
    assert masked_view(df, ["account_id"], CLEAR_ROLE).first()["account_id"] == "ACC00000123"
    for role in (ANALYST_ROLE, "ANYONE", "fraud_ops"):
        assert masked_view(df, ["account_id"], role).first()["account_id"] == "XXXXXXXX0123"


def test_conform_matches_columns_by_name(spark):
    row = conform(gold(spark, ROW), WAREHOUSE_ACCOUNT_DAY).first()
    assert list(row.asDict()) == [field.name for field in WAREHOUSE_ACCOUNT_DAY.fields]
    assert (row["avg_amount_30d_trailing"], row["prior_txn_count"], row["distinct_devices"]) == (
        Decimal("1.01"),
        7,
        3,
    )


def test_counts_beyond_32_bits_are_loaded(spark):
    row = conform(gold(spark, (*ROW[:2], 3_000_000_000, *ROW[3:])), WAREHOUSE_ACCOUNT_DAY).first()
    assert row["txns"] == 3_000_000_000
    hour = spark.createDataFrame(
        [("MER0001", 3, 3_000_000_000, 2_999_999_999, 0.5)],
        "merchant_id string, hour_of_day int, txns long, failed_txns long, failure_rate double",
    )
    assert conform(hour, WAREHOUSE_MERCHANT_HOUR).first()["failed_txns"] == 2_999_999_999


def test_audit_counts_a_key_once_however_often_it_repeats(spark):
    row = audit_constraints(gold(spark, ROW, ROW, ROW), WAREHOUSE_ACCOUNT_DAY).first()
    assert (row["rows"], row["duplicate_keys"]) == (3, 1)


def test_audit_counts_each_broken_rule(spark):
    other = (None, date(2025, 5, 2), 1, None, 1, None, 0, False, False)
    long = ("A" * 33, date(2025, 5, 2), 1, Decimal("1.00"), 1, None, 0, False, False)
    row = audit_constraints(gold(spark, ROW, ROW, other, long), WAREHOUSE_ACCOUNT_DAY).first()
    assert row.asDict() == {
        "table_name": "gold_account_day",
        "rows": 4,
        "duplicate_keys": 1,
        "null_violations": 2,
        "length_violations": 1,
    }


def test_audit_of_a_table_without_key_checks_lengths_only(spark):
    rows = [("T1", "A", "M", "x" * 65, "r", None)] * 2 + [(None, None, None, "late", "r", None)]
    df = spark.createDataFrame(
        rows,
        "txn_id string, account_id string, merchant_id string, txn_ts string, reject_reason string, "
        "_rejected_at timestamp",
    )
    row = audit_constraints(df, WAREHOUSE_REJECTS).first()
    assert (row["rows"], row["duplicate_keys"], row["null_violations"], row["length_violations"]) == (3, 0, 0, 2)


def test_audit_of_an_empty_table(spark):
    empty = spark.createDataFrame(
        [], "merchant_id string, hour_of_day int, txns long, failed_txns long, failure_rate double"
    )
    row = audit_constraints(empty, WAREHOUSE_MERCHANT_HOUR).first()
    assert (row["rows"], row["duplicate_keys"], row["null_violations"], row["length_violations"]) == (0, 0, 0, 0)
