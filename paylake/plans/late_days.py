"""Account days kept up to date by day, instead of from all history, when payments arrive late.

A late payment changes its own account and day, and the baselines of that account's next active days. Only
the payments of changed days are aggregated again. Accounts whose day really changed get their later days
computed anew, with their last active days before the change as input of the window; every other account's
rows are copied, and only days in which a row differs are written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from paylake.operators import account_day as days
from paylake.rules import Rules
from paylake.sources.lake import save_table, scratch_table

DAY = "account_day"
PROFILE = ("account_id", DAY, "txns", "max_amount", "distinct_devices")


@dataclass(frozen=True)
class Update:
    """What an update did: accounts computed anew, and the days that were written or emptied."""

    accounts: int
    written: tuple[date, ...]
    emptied: tuple[date, ...]


def build_days(spark: SparkSession, silver: DataFrame, name: str, rules: Rules = Rules()) -> None:
    """The whole account-day table, one partition a day."""
    save_table(days.account_day(silver, rules).hint("rebalance", DAY), name, partition_by=(DAY,))


def _differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one of two tables has; equal columns, no repeated rows."""
    signed = old.withColumn("_sign", F.lit(-1)).union(new.withColumn("_sign", F.lit(1)))
    return signed.groupBy(*old.columns).agg(F.sum("_sign").alias("_sign")).filter("_sign <> 0")


def _overwrite_days(spark: SparkSession, rows: DataFrame, name: str) -> None:
    """Replace the partitions that ``rows`` has rows for, and no others.

    The mode is a setting of the session: ``insertInto`` does not hand options to the write.
    """
    setting = "spark.sql.sources.partitionOverwriteMode"
    mode = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, mode)


def update_days(
    spark: SparkSession, silver: DataFrame, name: str, changed: Sequence[date], rules: Rules = Rules()
) -> Update:
    """Bring the table ``name`` up to date with ``silver``, of which only the days ``changed`` differ.

    The result equals ``build_days`` over ``silver``. A day may gain, lose or change payments. Silver
    laid out by day is read for the changed days only. Days are replaced by one dynamic
    partition overwrite: readers that list files while it commits can see some days new and others old. To
    let them see one state only, update a copy and publish it, see ``lake.Release``. The driver holds dates.
    """
    table = spark.table(name)
    columns = table.columns
    if not changed:
        return Update(0, (), ())
    in_changed = F.col(DAY).isin(list(changed))
    fresh = scratch_table(spark, days.daily_profile(silver.filter(in_changed)), "fresh-days")
    old = table.filter(in_changed).select(*PROFILE)
    first = _differing(old, fresh).groupBy("account_id").agg(F.min(DAY).alias("_since"))
    touched = scratch_table(spark, first, "touched-accounts")
    profile = table.filter(~in_changed).select(*PROFILE).union(fresh).join(touched, "account_id")
    # The halo: the last active days before an account's first changed one.
    back = Window.partitionBy("account_id").orderBy(F.desc(DAY))
    halo = (
        profile.filter(F.col(DAY) < F.col("_since"))
        .withColumn("_back", F.row_number().over(back))
        .filter(F.col("_back") <= rules.baseline_days)
        .drop("_back")
    )
    window_input = profile.filter(F.col(DAY) >= F.col("_since")).unionByName(halo)
    rebuilt = days.with_flags(days.with_baseline(window_input, rules), rules)
    rebuilt = scratch_table(spark, rebuilt.filter(F.col(DAY) >= F.col("_since")).select(*columns), "rebuilt-days")
    before = table.join(touched, "account_id").filter(F.col(DAY) >= F.col("_since")).select(*columns)
    stale = sorted(row[DAY] for row in _differing(before, rebuilt).select(DAY).distinct().collect())
    if not stale:
        return Update(0, (), ())
    in_stale = F.col(DAY).isin(stale)
    # Rows of a touched account before its first change stay, as do all rows of the others.
    kept = table.filter(in_stale).join(touched, "account_id", "left")
    kept = kept.filter(F.col("_since").isNull() | (F.col(DAY) < F.col("_since"))).select(*columns)
    content = scratch_table(spark, kept.union(rebuilt.filter(in_stale)), "stale-days")
    written = sorted(row[DAY] for row in content.select(DAY).distinct().collect())
    _overwrite_days(spark, content.hint("rebalance", DAY), name)
    emptied = [day for day in stale if day not in set(written)]
    for day in emptied:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({DAY} = DATE '{day.isoformat()}')")
    return Update(touched.count(), tuple(written), tuple(emptied))
