"""Typing and the first-match reject cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake.functions.numbers import try_money
from paylake.functions.times import instant, try_instant
from paylake.rules import Rules
from paylake.schemas import MALFORMED

# Reject reasons, in order of precedence.
MALFORMED_LINE = "malformed_line"
UNPARSEABLE_AMOUNT = "unparseable_amount"
UNKNOWN_ACCOUNT = "unknown_account"
TIMESTAMP_OUT_OF_RANGE = "timestamp_out_of_range"
MISSING_TXN_ID = "missing_txn_id"

REJECT_COLUMNS = ["txn_id", "account_id", "merchant_id", "txn_ts", "reject_reason"]


def parse(payments: DataFrame) -> DataFrame:
    """Add typed amount and time; NULL where the text does not parse."""
    return payments.withColumns(
        {
            "amount_cast": try_money(F.col("amount")),
            "txn_ts_cast": try_instant(F.col("txn_ts")),
        }
    )


def sentinel_account(rules: Rules) -> Column:
    """True for the placeholder account and for a missing one."""
    account = F.col("account_id")
    return account.isNull() | (account == rules.unknown_account)


def in_period(rules: Rules) -> Column:
    """True inside the closed valid period; False for a NULL time."""
    inside = F.col("txn_ts_cast").between(instant(rules.valid_from), instant(rules.valid_to))
    return F.coalesce(inside, F.lit(False))


def classify(parsed: DataFrame, rules: Rules, unknown: Column | None = None) -> DataFrame:
    """Add ``reject_reason``: the first failed test, NULL for a clean row.

    One CASE column replaces a filter per reason, so every row gets exactly one
    outcome in one pass. ``unknown`` overrides the account test. A malformed line is told
    first, because its values may stand in the wrong columns. A missing id is
    tested last, so it never changes the outcome of the other tests.
    """
    unknown = sentinel_account(rules) if unknown is None else unknown
    malformed = F.col(MALFORMED).isNotNull() if MALFORMED in parsed.columns else F.lit(False)
    reason = (
        F.when(malformed, MALFORMED_LINE)
        .when(F.col("amount_cast").isNull(), UNPARSEABLE_AMOUNT)
        .when(unknown, UNKNOWN_ACCOUNT)
        .when(~in_period(rules), TIMESTAMP_OUT_OF_RANGE)
        .when(F.col("txn_id").isNull(), MISSING_TXN_ID)
    )
    return parsed.withColumn("reject_reason", reason)


def rejects(classified: DataFrame) -> DataFrame:
    """Quarantined rows with their raw time text."""
    return classified.filter(F.col("reject_reason").isNotNull()).select(*REJECT_COLUMNS)


def clean(classified: DataFrame) -> DataFrame:
    """Rows that passed every test, typed, with the account day."""
    typed = classified.filter(F.col("reject_reason").isNull()).withColumns(
        {
            "amount": F.col("amount_cast"),
            "txn_ts": F.col("txn_ts_cast"),
            "account_day": F.to_date("txn_ts_cast"),
        }
    )
    return typed.drop("amount_cast", "txn_ts_cast", "reject_reason", MALFORMED)


def outcomes_by_name(clean_rows: DataFrame, reject_rows: DataFrame) -> DataFrame:
    """Clean and rejected rows in one table, united by name.

    The two differ: rejects hold the raw time text and a reason, clean rows the typed time, the
    amount and the day. Columns that one side lacks are NULL there.
    """
    rejected = reject_rows.withColumnRenamed("txn_ts", "raw_txn_ts")
    return clean_rows.unionByName(rejected, allowMissingColumns=True)
