"""Referential check of payments against the account master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake.sources.lake import scratch_table

# Largest list of account ids that is broadcast, and the size of one entry on top of its text.
BROADCAST_BYTES = 64 * 1024 * 1024
ENTRY_BYTES = 64


def id_list_bytes(ids: DataFrame, key: str = "account_id") -> int:
    """Measured size of the ids as a broadcast list, an upper bound."""
    size = ids.agg(F.coalesce(F.sum(F.octet_length(key) + ENTRY_BYTES), F.lit(0)).alias("bytes"))
    return size.first()["bytes"]


def unknown_ids(ids: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """The distinct ids of ``ids`` that ``known`` (``_key``, distinct) does not list, as a written table.

    Ids are made distinct before their shuffle, so a hot id sends one row per task, and only ids move.
    """
    distinct = ids.select(F.col(key).cast("string").alias("_key")).filter("_key IS NOT NULL").distinct()
    return scratch_table(ids.sparkSession, distinct.join(known, "_key", "left_anti"), "unknown-ids")


def flag_known(
    rows: DataFrame,
    key: str,
    master: DataFrame,
    flag: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Add ``flag``: does the master list this row's ``key``? False without a key.

    A master measured to be small is broadcast. Of a larger one only the verdict on the ids that occur is
    needed: the ids that it lacks are found by a semi-join reduction, and that list, measured in
    its turn, is broadcast, so the rows are not shuffled. ``ids`` is where the ids are taken from, any
    table that holds them all; give one where ``rows`` is costly to compute twice.

    Where even the list of unknown ids is large, the rows are joined by shuffle, each master id once. A
    hot key is left to AQE, which splits the rows' side of a skewed left join by
    map output and reads the one matching id with each part. Rows without a key need no
    match: they get join keys of their own, spread by content, that no master holds.
    """
    known = master.select(F.col(key).cast("string").alias("_key")).filter("_key IS NOT NULL").distinct()
    if id_list_bytes(master.select(F.col(key).cast("string").alias("account_id"))) <= broadcast_bytes:
        return _with_flag(rows, key, F.broadcast(known.withColumn(flag, F.lit(True))), flag, F.lit(False))
    # Written first: AQE splits a skewed join only when both sides come straight from a shuffle.
    known = scratch_table(rows.sparkSession, known, "known-ids")
    unknown = unknown_ids(rows if ids is None else ids, key, known)
    if id_list_bytes(unknown, "_key") <= broadcast_bytes:
        return _with_flag(rows, key, F.broadcast(unknown.withColumn(flag, F.lit(False))), flag, F.col(key).isNotNull())
    alone = F.concat(F.lit("\0"), F.xxhash64(*rows.columns).cast("string"))
    return _with_flag(rows, key, known.withColumn(flag, F.lit(True)), flag, F.lit(False), alone)


def _with_flag(
    rows: DataFrame, key: str, flagged: DataFrame, flag: str, other: Column, no_key: Column | None = None
) -> DataFrame:
    """``rows`` with the flag of their key in ``flagged``, ``other`` for keys it does not hold."""
    text = F.col(key).cast("string")
    joined = rows.withColumn("_key", text if no_key is None else F.coalesce(text, no_key)).join(flagged, "_key", "left")
    return joined.select(*rows.columns, F.coalesce(flagged[flag], other).alias(flag))


def flag_known_accounts(
    payments: DataFrame,
    accounts: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Add ``account_known``: does the master list this account?"""
    return flag_known(payments, "account_id", accounts, "account_known", broadcast_bytes, ids)


def not_in_master() -> Column:
    return ~F.col("account_known")
