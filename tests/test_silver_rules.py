"""Typing, deduplication and the reject cascade on hand-made rows."""

from datetime import datetime
from decimal import Decimal

import pytest

from paylake.operators import quarantine
from paylake.operators.accounts import flag_known_accounts, id_list_bytes, not_in_master
from paylake.operators.dedup import distinct_payments, first_per_key
from paylake.rules import Rules

RULES = Rules()


def reasons(df, rules=RULES):
    classified = quarantine.classify(quarantine.parse(df), rules)
    return {row["txn_id"]: row["reject_reason"] for row in classified.collect()}


@pytest.mark.parametrize(
    "text, value",
    [
        ("12.345", Decimal("12.35")),
        ("NA", None),
        (None, None),
        ("", None),
        (" 5 ", Decimal("5.00")),
        ("1e3", Decimal("1000.00")),
        ("-7.5", Decimal("-7.50")),
        ("99999999999999999", None),
    ],
)
def test_amount_text(payments, text, value):
    assert quarantine.parse(payments({"amount": text})).first()["amount_cast"] == value


@pytest.mark.parametrize(
    "text, reason",
    [
        ("2025-05-20 12:00:00", None),
        ("bad", "timestamp_out_of_range"),
        (None, "timestamp_out_of_range"),
        ("1970-01-01 00:00:00", "timestamp_out_of_range"),
        ("2025-05-01 00:00:00", None),
        ("2025-04-30 23:59:59", "timestamp_out_of_range"),
        ("2025-06-14 23:59:59", None),
        ("2025-06-14 23:59:59.5", "timestamp_out_of_range"),
        ("12:30:00", "timestamp_out_of_range"),
    ],
)
def test_period_bounds(payments, text, reason):
    assert reasons(payments({"txn_ts": text}))["T00000000"] == reason


@pytest.mark.parametrize("account", ["ACC99999999", None])
def test_unknown_account(payments, account):
    assert reasons(payments({"account_id": account}))["T00000000"] == "unknown_account"


def test_first_failed_test_wins(payments):
    late, unknown, bad = {"txn_ts": "1970-01-01 00:00:00"}, {"account_id": "ACC99999999"}, {"amount": "NA"}
    found = reasons(payments(late, {**late, **unknown}, {**late, **unknown, **bad}, bad))
    assert list(found.values()) == [
        "timestamp_out_of_range",
        "unknown_account",
        "unparseable_amount",
        "unparseable_amount",
    ]


def test_times_do_not_depend_on_the_session_zone(spark, payments):
    df = payments({"txn_ts": "2025-05-01 00:30:00"})
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = quarantine.clean(quarantine.classify(quarantine.parse(df), RULES)).first()
            assert row["txn_ts"] == datetime(2025, 5, 1, 0, 30)
            assert row["account_day"].isoformat() == "2025-05-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clean_and_rejects_split_every_row(payments):
    df = payments({}, {"amount": "NA"}, {"txn_ts": None}, {"account_id": None}, {"txn_id": None})
    classified = quarantine.classify(quarantine.parse(df), RULES)
    assert quarantine.clean(classified).columns == [*df.columns, "account_day"]
    assert quarantine.clean(classified).count() == 1
    assert quarantine.rejects(classified).count() == 4


def test_outcomes_of_different_columns_unite_by_name(payments):
    df = quarantine.parse(payments({}, {"amount": "x"}, {"txn_ts": "x"}, {"account_id": None}))
    classified = quarantine.classify(df, RULES)
    clean, rejects = quarantine.clean(classified), quarantine.rejects(classified)
    outcomes = quarantine.outcomes_by_name(clean, rejects)
    assert outcomes.columns == [*clean.columns, "raw_txn_ts", "reject_reason"]
    bad = outcomes.filter("reject_reason IS NOT NULL")
    assert sorted((r["raw_txn_ts"], r["txn_ts"], r["amount"]) for r in bad.collect()) == sorted(
        (r["txn_ts"], None, None) for r in rejects.collect()
    )
    assert outcomes.filter("reject_reason IS NULL").select(*clean.columns).collect() == clean.collect()


def test_exact_copies_collapse(payments):
    copy = {"txn_id": "T1", "amount": "5.00"}
    assert distinct_payments(payments(copy, copy, copy, {"txn_id": "T2"})).count() == 2


def test_survivor_of_conflicting_copies_is_the_earliest_on_any_layout(payments):
    rows = [
        {"txn_id": "T1", "txn_ts": "2025-05-03 00:00:00", "amount": "1.00"},
        {"txn_id": "T1", "txn_ts": "2025-05-02 00:00:00", "amount": "9.00"},
        {"txn_id": "T1", "txn_ts": "2025-05-02 00:00:00", "amount": "3.00"},
    ]
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        for tasks in (1, 3):
            survivor = distinct_payments(payments(*order).repartition(tasks)).first()
            assert (survivor["txn_ts"], survivor["amount"]) == ("2025-05-02 00:00:00", "3.00")


def test_rows_without_id_merge_only_when_equal_and_are_rejected(payments):
    lost = {"txn_id": None, "amount": "5.00"}
    unique = distinct_payments(payments(lost, lost, {"txn_id": None, "amount": "6.00"}))
    assert sorted(row["amount"] for row in unique.collect()) == ["5.00", "6.00"]
    assert set(reasons(unique).values()) == {"missing_txn_id"}


def test_missing_id_does_not_hide_the_other_reasons(payments):
    assert reasons(payments({"txn_id": None, "amount": "NA"}))[None] == "unparseable_amount"


def test_first_per_key_orders_nulls_last(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 7), (3, None)], "k int, v int")
    assert sorted(tuple(r) for r in first_per_key(df, ["k"], ["v"]).collect()) == [(1, 5), (2, 7), (3, None)]


@pytest.mark.parametrize("missing", ["txn_ts", "amount", "account_id"])
def test_a_copy_with_a_missing_value_never_displaces_the_good_one(payments, missing):
    good, lacking = {"txn_id": "T1", "amount": "5.00"}, {"txn_id": "T1", "amount": "5.00", missing: None}
    for order in ((good, lacking), (lacking, good), (lacking, good, lacking)):
        for tasks in (1, 3):
            unique = distinct_payments(payments(*order).repartition(tasks))
            classified = quarantine.classify(quarantine.parse(unique), RULES)
            assert [r["txn_id"] for r in quarantine.clean(classified).collect()] == ["T1"]
            assert quarantine.rejects(classified).isEmpty()


@pytest.mark.parametrize("broadcast_bytes", [10**9, 0])
def test_referential_check_on_both_join_paths(spark, payments, broadcast_bytes):
    accounts = spark.createDataFrame([("ACC1",), ("ACC2",), ("ACC2",), (None,)], "account_id string")
    df = payments(
        *[{"account_id": "ACC1"}] * 20, {"account_id": "ACC2"}, {"account_id": "ACC3"}, {"account_id": None}
    )
    flagged = flag_known_accounts(df, accounts, broadcast_bytes=broadcast_bytes)
    assert flagged.columns == [*df.columns, "account_known"]
    assert flagged.count() == 23
    classified = quarantine.classify(quarantine.parse(flagged), RULES, unknown=not_in_master())
    rejected = quarantine.rejects(classified).collect()
    assert sorted(str(row["account_id"]) for row in rejected) == ["ACC3", "None"]
    assert {row["reject_reason"] for row in rejected} == {"unknown_account"}


def test_id_list_size_grows_with_the_master(spark):
    one = spark.createDataFrame([("ACC00000001",)], "account_id string")
    assert id_list_bytes(one) == 11 + 64
    assert id_list_bytes(one.filter("false")) == 0
