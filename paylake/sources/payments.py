"""Raw payment and account views over the test tables.

The test tables are clean, so the payment view plants a fixed share of defects:
prime moduli spread them over all merchants and make some of them overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake.functions.text import padded_id
from paylake.functions.times import seconds_text
from paylake.rules import EVENT_RULES
from paylake.schemas import ACCOUNT_COLUMNS, MONEY, PAYMENT_COLUMNS

# Fixed values: (modulus, remainder) of the event id for each planted defect.
COPY_RULE = (97, 9)
UNKNOWN_ACCOUNT_RULE = (83, 7)
EPOCH_TIME_RULE = (127, 5)
BAD_TIME_RULE = (149, 11)
BAD_AMOUNT_RULE = (41, 3)
# Fixed values: (modulus, remainder) of the customers that the account master lacks.
MASTER_HOLES = (13, 4)
# Planted texts and value ranges.
EPOCH_TIME = "1970-01-01 00:00:00"
BAD_TIME = "not-a-time"
BAD_AMOUNT = "NA"
MERCHANTS = 40
CATEGORIES = 12
DEVICES = 10
BANKS = 8
CITIES = 10


def _hits(rule: tuple[int, int]) -> Column:
    modulus, remainder = rule
    return F.col("event_id") % modulus == remainder


def _payment_columns() -> list[Column]:
    event = F.col("event_id")
    merchant = event % MERCHANTS
    device = F.get_json_object("props", "$.k").cast("long") % DEVICES
    fields = {
        "txn_id": padded_id("T", 8, event),
        "account_id": F.when(
            _hits(UNKNOWN_ACCOUNT_RULE), F.lit(EVENT_RULES.unknown_account)
        ).otherwise(padded_id("ACC", 8, F.col("user_id"))),
        "merchant_id": padded_id("MER", 4, merchant),
        "merchant_category": padded_id("MC", 2, merchant % CATEGORIES),
        "txn_ts": F.when(_hits(EPOCH_TIME_RULE), F.lit(EPOCH_TIME))
        .when(_hits(BAD_TIME_RULE), F.lit(BAD_TIME))
        .otherwise(seconds_text(F.col("ts"))),
        "device_id": padded_id("DEV", 7, device),
        "status": F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS"),
        "amount": F.when(_hits(BAD_AMOUNT_RULE), F.lit(BAD_AMOUNT)).otherwise(
            F.col("value").cast(MONEY).cast("string")
        ),
    }
    return [fields[name].alias(name) for name in PAYMENT_COLUMNS]


def raw_payments(events: DataFrame) -> DataFrame:
    """Dirty payments: one scan, planted rows emitted twice."""
    times = F.when(_hits(COPY_RULE), F.lit(2)).otherwise(F.lit(1))
    copies = events.select("*", F.explode(F.sequence(F.lit(1), times)).alias("_copy"))
    return copies.select(*_payment_columns())


def raw_payments_union(events: DataFrame) -> DataFrame:
    """The same rows as a positional UNION ALL of all rows and the planted copies."""
    every = events.select("*", _hits(COPY_RULE).alias("_copied"))
    main = every.select(*_payment_columns())
    again = every.filter("_copied").select(*_payment_columns())
    return main.union(again)


def account_master(ids: DataFrame, column: str) -> DataFrame:
    """Account master rows for a column of account numbers."""
    number = F.col(column)
    fields = {
        "account_id": padded_id("ACC", 8, number),
        "bank": F.format_string("BANK%d", number % BANKS),
        "home_city": F.format_string("CITY%d", number % CITIES),
        "primary_device": padded_id("DEV", 7, number),
        "secondary_device": padded_id("DEV9", 6, number),
    }
    return ids.select(*[fields[name].alias(name) for name in ACCOUNT_COLUMNS])


def with_line_breaks(raw: DataFrame) -> DataFrame:
    """Payments with line breaks, commas and quotes inside some values, as free text fields have them."""
    number = F.substring("txn_id", 2, 8).cast("long")
    device = F.when(number % 5 == 1, F.concat("device_id", F.lit('\nold, "spare"\n'))).otherwise(F.col("device_id"))
    merchant = F.when(number % 7 == 2, F.concat(F.lit('"\n\n'), "merchant_id")).otherwise(F.col("merchant_id"))
    return raw.withColumns({"device_id": device, "merchant_id": merchant})
