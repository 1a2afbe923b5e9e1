"""The batch job: two CSV inputs to bronze, silver and gold tables.

Write, audit, publish. ``stage`` writes every layer as a new version that no reader knows: each layer once,
the next one from the written table, so no stage is run again from the raw files. Counts are observed
during the writes, but for the conservation check, which reads bronze, silver and rejects each from its
written table. ``publish`` first runs that check and the declared constraints over the staged tables; only
when both hold does any published name change. Clean and rejected rows come from one deduplication and one
write: they are the two partitions of ``silver_classified``, published as the views ``silver_txns`` and
``silver_rejects``, or copied into tables of these names on request.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from paylake.operators import account_day as days
from paylake.operators import bronze, governance, quarantine, reconcile
from paylake.operators.accounts import BROADCAST_BYTES, flag_known_accounts, not_in_master
from paylake.operators.dedup import distinct_payments
from paylake.operators.merchant_hour import merchant_hour
from paylake.rules import Rules
from paylake.schemas import (
    ACCOUNT_COLUMNS,
    LINEAGE_COLUMNS,
    MALFORMED,
    PAYMENT_COLUMNS,
    RAW_ACCOUNTS,
    RAW_PAYMENTS,
    WAREHOUSE_TABLES,
)
from paylake.sources.files import read_csv
from paylake.sources.lake import KEPT_VERSIONS, Release, check_replaceable, save_table, save_view
from paylake.sources.quoted import read_quoted_csv

CLEAN = "clean"
REJECTED = "rejected"
# Names that a build publishes, and those that become managed tables on request.
MANAGED = ("silver_txns", "silver_rejects", "gold_account_day", "gold_merchant_hour")
PUBLISHED = ("bronze_accounts", "bronze_txns", "silver_classified", *MANAGED)


@dataclass(frozen=True)
class LayerReport:
    bronze_accounts: int
    bronze_txns: int
    duplicates: int
    malformed_line: int
    unparseable_amount: int
    unknown_account: int
    timestamp_out_of_range: int
    missing_txn_id: int
    silver_rejects: int
    silver_txns: int
    account_days: int
    device_bursts: int
    amount_spikes: int
    merchant_hours: int

    @property
    def balanced(self) -> bool:
        return self.bronze_txns - self.duplicates - self.silver_rejects == self.silver_txns

    def as_dict(self) -> dict[str, int]:
        return asdict(self)


def silver_storage(classified: DataFrame) -> DataFrame:
    """Physical silver row: typed columns for clean rows, raw time text for rejects."""
    bad = F.col("reject_reason").isNotNull()
    return classified.select(
        "txn_id",
        "account_id",
        "merchant_id",
        "merchant_category",
        "device_id",
        "status",
        F.col("amount_cast").alias("amount"),
        F.col("txn_ts_cast").alias("txn_ts"),
        F.when(~bad, F.to_date("txn_ts_cast")).alias("account_day"),
        *LINEAGE_COLUMNS,
        F.when(bad, F.col("txn_ts")).alias("raw_txn_ts"),
        MALFORMED,
        "reject_reason",
        F.when(bad, F.current_timestamp()).alias("_rejected_at"),
        F.when(bad, REJECTED).otherwise(CLEAN).alias("disposition"),
    )


@dataclass
class Build:
    """What ``stage`` wrote, waiting to be checked and published."""

    release: Release
    observed: dict[str, int]
    layout: tuple[str, ...]
    silver_tables: bool


def stage(
    spark: SparkSession,
    raw_dir: str,
    rules: Rules = Rules(),
    database: str | None = None,
    check_accounts: bool = False,
    silver_by_day: bool = False,
    silver_tables: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    line_records: bool = False,
) -> Build:
    """Write a version of all tables from ``raw_dir/accounts.csv`` and ``raw_dir/txns.csv``; publish nothing.

    ``check_accounts`` rejects accounts missing from the account file instead of only
    the placeholder account. ``silver_by_day`` lays silver out by account day for
    readers of single days; the rebalance lets Spark split a large day over tasks and
    keeps small days from becoming small files, at the price of one more shuffle.
    ``silver_tables`` asks ``publish`` for managed tables in place of views. An account list, or a list of
    unknown ids, up to ``broadcast_bytes`` is broadcast. ``line_records`` says that no quoted field holds a
    line break, which saves the pass over the files that looks for them.

    Raises ``ValueError`` when a published name is taken by the other kind of object.
    """
    scan = read_csv if line_records else read_quoted_csv
    release = Release(spark, database)
    for table in PUBLISHED:
        check_replaceable(spark, release.named(table), as_view=not (silver_tables and table in MANAGED))

    accounts = bronze.land(scan(spark, f"{raw_dir}/accounts.csv", RAW_ACCOUNTS), ACCOUNT_COLUMNS)
    account_counts = release.stage(accounts, "bronze_accounts")
    payments = bronze.land(scan(spark, f"{raw_dir}/txns.csv", RAW_PAYMENTS), PAYMENT_COLUMNS)
    release.stage(payments, "bronze_txns")

    # The fingerprint is most of a row's bytes and follows from the other columns, so
    # it stays out of the deduplication shuffle and is computed again behind it.
    landed = release.read("bronze_txns")
    unique = distinct_payments(landed.drop("_row_hash"))
    parsed = quarantine.parse(bronze.with_fingerprint(unique, PAYMENT_COLUMNS))
    unknown = None
    if check_accounts:
        master = release.read("bronze_accounts")
        parsed = flag_known_accounts(parsed, master, broadcast_bytes, ids=landed)
        unknown = not_in_master()
    storage = silver_storage(quarantine.classify(parsed, rules, unknown))
    layout = ("disposition",)
    if silver_by_day:
        layout = ("disposition", "account_day")
        storage = storage.hint("rebalance", *layout)
    release.stage(storage, "silver_classified", partition_by=layout)
    silver_columns = ", ".join([*PAYMENT_COLUMNS, *LINEAGE_COLUMNS, "account_day"])
    classified = release.staged("silver_classified")
    release.define("silver_txns", f"SELECT {silver_columns} FROM {classified} WHERE disposition = '{CLEAN}'")
    release.define(
        "silver_rejects",
        "SELECT txn_id, account_id, merchant_id, raw_txn_ts AS txn_ts, "
        f"reject_reason, _rejected_at FROM {classified} WHERE disposition = '{REJECTED}'",
    )

    silver = release.read("silver_txns")
    day_counts = release.stage(
        days.account_day(silver, rules),
        "gold_account_day",
        metrics={
            "device_bursts": F.count_if("is_device_burst"),
            "amount_spikes": F.count_if("is_amount_spike"),
        },
    )
    hour_counts = release.stage(merchant_hour(silver), "gold_merchant_hour")
    observed = {
        "bronze_accounts": account_counts["rows"],
        "account_days": day_counts["rows"],
        "device_bursts": day_counts["device_bursts"],
        "amount_spikes": day_counts["amount_spikes"],
        "merchant_hours": hour_counts["rows"],
    }
    return Build(release, observed, layout, silver_tables)


def publish(build: Build, keep: int = KEPT_VERSIONS, published: str | None = None) -> LayerReport:
    """Check the staged tables, then switch the published names to them.

    Raises ``ValueError`` when rows were lost, invented or exchanged on the way to silver, or when a
    warehouse table breaks its declared keys, NOT NULLs or lengths. Published names then
    show what they showed before, and the staged tables stay for inspection until a later build
    removes them or ``build.release.discard()`` does. With views each name changes in one step. Managed tables
    are copied from the staged ones after the check, and readers of a name fail during its copy.

    ``published`` names a second database for readers: one view of each warehouse table for all roles, whose
    ids are masked by the role that the reading user has then. See ``governance.publish_guarded``.
    """
    release, spark = build.release, build.release.spark
    counts = _conserved(release.read)
    audited = governance.audit_warehouse({declared.name: release.read(declared.name) for declared in WAREHOUSE_TABLES})
    broken = [row.asDict() for row in audited.collect() if any(row[name] for name in governance.VIOLATIONS)]
    if broken:
        raise ValueError(f"declared constraints are broken: {broken}")
    if build.silver_tables:
        for table in MANAGED:
            save_table(release.read(table), release.named(table))
            del release.views[table]
            spark.sql(f"DROP TABLE IF EXISTS {release.staged(table)}")
    release.publish(keep)
    publish_views(spark, release.named)
    if published:
        governance.publish_guarded(spark, published, release.database or spark.catalog.currentDatabase())
    return LayerReport(
        bronze_txns=counts["bronze_rows"],
        duplicates=counts["duplicate_rows"],
        malformed_line=counts["malformed_line_rows"],
        unparseable_amount=counts["unparseable_amount_rows"],
        unknown_account=counts["unknown_account_rows"],
        timestamp_out_of_range=counts["out_of_range_rows"],
        missing_txn_id=counts["missing_id_rows"],
        silver_rejects=counts["reject_rows"],
        silver_txns=counts["clean_rows"],
        **build.observed,
    )


def run(
    spark: SparkSession,
    raw_dir: str,
    rules: Rules = Rules(),
    database: str | None = None,
    keep: int = KEPT_VERSIONS,
    published: str | None = None,
    **options,
) -> LayerReport:
    """Stage all tables, check them and publish them; see ``stage`` for the options and ``publish`` for the checks."""
    return publish(stage(spark, raw_dir, rules, database, **options), keep, published)


def view_name(table: str, role: str) -> str:
    """The published view of a table for a role; roles without one read the masked view."""
    known = role if role == governance.CLEAR_ROLE else governance.ANALYST_ROLE
    return f"{table}_{known.lower()}"


def publish_views(spark: SparkSession, named) -> None:
    """One catalog view per warehouse table and role, with declared types and masked ids."""
    for declared in WAREHOUSE_TABLES:
        for role in (governance.CLEAR_ROLE, governance.ANALYST_ROLE):
            query = governance.masked_select(declared, named(declared.name), ["account_id"], role)
            save_view(spark, named(view_name(declared.name, role)), query)


def verify(spark: SparkSession, database: str | None = None) -> dict:
    """Count the published tables and raise ``ValueError`` unless no row was lost, invented or exchanged."""
    return _conserved(lambda table: spark.table(f"{database}.{table}" if database else table))


def _conserved(read: Callable[[str], DataFrame]) -> dict:
    checked = reconcile.reconciliation(read("bronze_txns"), read("silver_txns"), read("silver_rejects"))
    counts = checked.first().asDict()
    if not counts["balanced"]:
        raise ValueError(f"rows do not reconcile: {counts}")
    return counts
