"""One row per key.

Both forms are a ``row_number() == 1`` over a total order. Spark plans that as a
partial and a final group limit: each task keeps one row per key before the
shuffle, so a key with a third of all rows sends one row per task. The total
order makes the survivor the same on every run and on every retried task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from paylake.schemas import MALFORMED, PAYMENT_COLUMNS


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]
) -> DataFrame:
    """Keep the first row of each key in ``order``; NULLs in named columns sort last."""
    order = [F.asc_nulls_last(part) if isinstance(part, str) else part for part in order]
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def payment_identity(payments: DataFrame) -> list[Column]:
    """What makes two rows copies of one payment: the id.

    Rows without an id, and lines that do not have the declared fields, cannot be matched by
    id. They are copies only when all their raw columns agree, so none displaces a good row.
    """
    unmatched = F.col("txn_id").isNull()
    raw = list(PAYMENT_COLUMNS)
    if MALFORMED in payments.columns:
        unmatched = unmatched | F.col(MALFORMED).isNotNull()
        raw.append(MALFORMED)
    return [F.col("txn_id"), F.when(unmatched, F.struct(*raw))]


def distinct_payments(payments: DataFrame) -> DataFrame:
    """One row per identity: the earliest time text, other columns break ties.

    Missing values sort last, so a copy that lacks its time or amount never
    displaces one that has it.
    """
    others = [name for name in payments.columns if name not in ("txn_id", "txn_ts")]
    return first_per_key(payments, payment_identity(payments), ["txn_ts", *others])
