"""Row conservation and layer metrics, each as one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from paylake.operators.dedup import payment_identity
from paylake.operators.quarantine import (
    MALFORMED_LINE,
    MISSING_TXN_ID,
    TIMESTAMP_OUT_OF_RANGE,
    UNKNOWN_ACCOUNT,
    UNPARSEABLE_AMOUNT,
)

# Raw values that rejects keep of a row, besides its reason.
UNMATCHED_COLUMNS = ("txn_id", "account_id", "merchant_id", "txn_ts")


def reason_counts() -> dict[str, Column]:
    """Rejects by reason, as aggregates over rows with a ``reject_reason``."""
    reason = F.col("reject_reason")
    names = {
        "malformed_line_rows": MALFORMED_LINE,
        "unparseable_amount_rows": UNPARSEABLE_AMOUNT,
        "unknown_account_rows": UNKNOWN_ACCOUNT,
        "out_of_range_rows": TIMESTAMP_OUT_OF_RANGE,
        "missing_id_rows": MISSING_TXN_ID,
    }
    return {name: F.count_if(reason == value) for name, value in names.items()}


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """Merge one-row aggregates with different columns into one row.

    A by-name union with one final MAX per column; no join is needed.
    """
    stacked = one_row_frames[0]
    for frame in one_row_frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def _sum_of_hashes(text: Column) -> Column:
    """Order-free checksum: the exact sum of 60 bits of each text's MD5, as decimal text.

    MD5 is in every SQL engine, so the sum can be computed elsewhere too.
    """
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("decimal(20,0)")
    return F.coalesce(F.sum(head).cast("string"), F.lit("0"))


def _identity_text(row: Callable[[str], Column], unmatched: Column) -> Column:
    """What a payment is known by in every layer: its id.

    Rows that cannot be matched by id are told by the raw values that rejects keep of them.
    """
    kept = F.concat_ws("|", *[F.coalesce(row(name), F.lit("\\N")) for name in UNMATCHED_COLUMNS])
    return F.when(unmatched, F.concat(F.lit("?"), kept)).otherwise(row("txn_id"))


def duplicate_counts(raw: DataFrame) -> DataFrame:
    """Rows, distinct payments and surplus copies, counted from the raw rows alone.

    Copies are those deduplication merges: see ``payment_identity``. Rows are counted per
    identity before the shuffle, so a payment copied very often sends one row per task.
    """
    return _per_identity(raw).agg(*_duplicates())


def _per_identity(raw: DataFrame) -> DataFrame:
    keys = [key.alias(f"_key{i}") for i, key in enumerate(payment_identity(raw))]
    return raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _duplicates() -> list[Column]:
    return [
        F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_rows"),
        F.count(F.lit(1)).alias("distinct_payments"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    ]


def reconciliation(raw: DataFrame, silver: DataFrame, rejected: DataFrame) -> DataFrame:
    """Every layer counted and summed from its own rows, with the verdict in ``balanced``.

    ``balanced`` holds when raw rows less surplus copies less rejects are the clean rows, and when the
    payments that came in are those that went out: ``raw_checksum`` sums hashes of the distinct
    identities of the raw rows, ``kept_checksum`` those of clean rows and rejects. Both are exact and
    free of order, so one row lost and another invented shows too, but for rows that share
    all that identifies them.
    """
    alone = F.col("_key1").isNotNull()
    identity = _identity_text(lambda name: F.when(alone, F.col(f"_key1.{name}")).otherwise(F.col("_key0")), alone)
    unmatched = F.col("txn_id").isNull() | F.coalesce(F.col("reject_reason") == MALFORMED_LINE, F.lit(False))
    names = [*UNMATCHED_COLUMNS, "reject_reason"]
    kept = silver.select("txn_id", *[F.lit(None).cast("string").alias(name) for name in names[1:]]).unionByName(
        rejected.select(*names)
    )
    counts = side_by_side(
        _per_identity(raw).agg(*_duplicates(), _sum_of_hashes(identity).alias("raw_checksum")),
        kept.agg(
            # Every reject has a reason, no clean row has one.
            F.count_if(F.col("reject_reason").isNull()).alias("clean_rows"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("reject_rows"),
            *[expr.alias(name) for name, expr in reason_counts().items()],
            _sum_of_hashes(_identity_text(F.col, unmatched)).alias("kept_checksum"),
        ),
    )
    rest = F.col("bronze_rows") - F.col("duplicate_rows") - F.col("reject_rows")
    same = F.col("raw_checksum") == F.col("kept_checksum")
    return counts.withColumn("balanced", (rest == F.col("clean_rows")) & same)


def layer_metrics(
    accounts: DataFrame,
    raw: DataFrame,
    classified: DataFrame,
    account_days: DataFrame,
    merchant_hours: DataFrame,
) -> DataFrame:
    """All published layer counts in one row; flags are counted in the same pass.

    Give written tables: each frame is read once, and a lazy ``classified`` would be
    deduplicated again for every frame derived from it.
    """
    return side_by_side(
        accounts.agg(F.count(F.lit(1)).alias("bronze_accounts")),
        raw.agg(F.count(F.lit(1)).alias("bronze_txns")),
        classified.agg(
            F.count(F.lit(1)).alias("deduped_txns"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("silver_rejects"),
            F.count_if(F.col("reject_reason").isNull()).alias("silver_txns"),
        ),
        account_days.agg(
            F.count(F.lit(1)).alias("account_days"),
            F.count_if("is_device_burst").alias("device_bursts"),
            F.count_if("is_amount_spike").alias("amount_spikes"),
        ),
        merchant_hours.agg(F.count(F.lit(1)).alias("merchant_hours")),
    ).withColumn("duplicates", F.col("bronze_txns") - F.col("deduped_txns"))
