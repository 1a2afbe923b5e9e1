"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Everything is derived from the given tables. Queries have no side effects except that some
write a fresh folder or database below the shared scratch folder. Decimals
leave as doubles, because other engines report them with other scales.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from paylake.functions.numbers import rounded_int
from paylake.functions.text import hash_bucket, padded_id
from paylake.operators import accounts as referential
from paylake.operators import account_day as days
from paylake.operators import bronze, governance, quarantine, reconcile
from paylake.operators.dedup import distinct_payments, first_per_key
from paylake.operators.merchant_hour import merchant_hour
from paylake.plans import late_days, medallion, questions
from paylake.rules import EVENT_RULES as RULES
from paylake.schemas import (
    ACCOUNT_COLUMNS,
    MALFORMED,
    MONEY,
    ORDER_LINES,
    PAYMENT_COLUMNS,
    RAW_PAYMENTS,
    WAREHOUSE_ACCOUNT_DAY,
    WAREHOUSE_MERCHANT_HOUR,
    WAREHOUSE_REJECTS,
)
from paylake.session import scratch_path
from paylake.sources import payments
from paylake.sources.files import read_csv, read_csv_inferred, table, write_csv
from paylake.sources.lake import scratch_table
from paylake.sources.lines import broken_lines
from paylake.sources.quoted import read_quoted_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register ``build`` under its own name, with decimals cast to double."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(spark, sf_dir)
        decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
        return df.withColumns({name: F.col(name).cast("double") for name in decimals})

    QUERIES[build.__name__] = run
    return run


# Layers of the lake as lazy DataFrames over the test tables.


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.raw_payments(table(spark, sf_dir, "events"))


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.account_master(table(spark, sf_dir, "customer"), "c_custkey")


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.parse(distinct_payments(_raw(spark, sf_dir)))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.classify(_parsed(spark, sf_dir), RULES)


def _stored_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified rows as a written table, for queries that read them more than once."""
    return scratch_table(spark, _classified(spark, sf_dir), "classified")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.clean(_classified(spark, sf_dir))


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.rejects(_classified(spark, sf_dir))


def _account_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.account_day(_silver(spark, sf_dir), RULES)


def _merchant_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merchant_hour(_silver(spark, sf_dir))


# Sources and sinks


@query
def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir)


@query
def raw_payments_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments.raw_payments_union(table(spark, sf_dir, "events"))


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments written as CSV and scanned again with the declared schema."""
    path = scratch_path(spark, "payments-csv")
    write_csv(_raw(spark, sf_dir), path)
    return read_csv(spark, path, RAW_PAYMENTS).filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


@query
def csv_quoted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments whose devices and merchants have line breaks, commas and quotes in them, written, landed and read."""
    path = scratch_path(spark, "payments-csv")
    write_csv(payments.with_line_breaks(_raw(spark, sf_dir)), path)
    landed = read_quoted_csv(spark, path, RAW_PAYMENTS).filter(F.col(MALFORMED).isNull())
    return scratch_table(spark, landed.select(*PAYMENT_COLUMNS), "landed")


@query
def csv_inferred_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments written as CSV and counted through a scan with inferred types."""
    path = scratch_path(spark, "payments-csv")
    write_csv(_raw(spark, sf_dir), path)
    return read_csv_inferred(spark, path).agg(F.count(F.lit(1)).alias("bronze_txns"))


# Bronze


@query
def bronze_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.with_fingerprint(_raw(spark, sf_dir), PAYMENT_COLUMNS)


@query
def bronze_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.with_fingerprint(_accounts(spark, sf_dir), ACCOUNT_COLUMNS)


@query
def bronze_ingest_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed CSV payments: every row has its file, one ingest time and a fingerprint."""
    path = scratch_path(spark, "payments-csv")
    write_csv(_raw(spark, sf_dir), path)
    landed = bronze.land(read_csv(spark, path, RAW_PAYMENTS), PAYMENT_COLUMNS)
    return landed.agg(
        F.count(F.lit(1)).alias("bronze_txns"),
        F.count_if(F.col("_source_file").contains(path)).alias("rows_with_source_file"),
        F.count_distinct("_ingested_at").alias("ingest_times"),
        F.count_if(F.length("_row_hash") == 64).alias("rows_with_fingerprint"),
        F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed_lines"),
    )


def _build(
    spark: SparkSession, sf_dir: str, inputs: list[DataFrame], published: str | None = None
) -> str:
    """Run the whole job over CSV files of each input in turn, into one fresh database."""
    database = f"paylake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'lake')}'")
    for events in inputs:
        raw_dir = scratch_path(spark, "raw")
        write_csv(payments.raw_payments(events), f"{raw_dir}/txns.csv")
        write_csv(_accounts(spark, sf_dir), f"{raw_dir}/accounts.csv")
        medallion.run(spark, raw_dir, RULES, database, published=published)
    return database


@query
def lake_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account days read back from the catalog after a full build."""
    database = _build(spark, sf_dir, [table(spark, sf_dir, "events")])
    return spark.table(f"{database}.gold_account_day")


@query
def lake_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant hours after a build over half of the events and a second one over all."""
    events = table(spark, sf_dir, "events")
    database = _build(spark, sf_dir, [events.filter("event_id % 2 = 0"), events])
    return spark.table(f"{database}.gold_merchant_hour")


@query
def lake_masked_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects as the analysts' published view shows them after a build."""
    database = _build(spark, sf_dir, [table(spark, sf_dir, "events")])
    name = medallion.view_name("silver_rejects", governance.ANALYST_ROLE)
    return spark.table(f"{database}.{name}").drop("_rejected_at")


def _published(spark: SparkSession, sf_dir: str, members: list[tuple[str, str]]) -> str:
    """A build with a database for readers, and the given users' roles."""
    published = f"paylake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {published} LOCATION '{scratch_path(spark, 'published')}'")
    database = _build(spark, sf_dir, [table(spark, sf_dir, "events")], published)
    governance.set_members(spark, database, members)
    return published


@query
def lake_published_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects as a reader without a role sees them under the one published name."""
    published = _published(spark, sf_dir, [("somebody else", governance.CLEAR_ROLE)])
    return spark.table(f"{published}.silver_rejects").drop("_rejected_at")


@query
def lake_published_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects under the same name for a member of the role that sees clear ids."""
    user = spark.sql("SELECT session_user() AS name").first()["name"]
    published = _published(spark, sf_dir, [(user, governance.CLEAR_ROLE)])
    return spark.table(f"{published}.silver_rejects").drop("_rejected_at")


# Silver


@query
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_payments(_raw(spark, sf_dir))


@query
def dedup_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each order line; duplicates of the key differ in other columns."""
    lines = table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    return first_per_key(lines, key, [name for name in lines.columns if name not in key])


@query
def typed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.parse(_raw(spark, sf_dir)).select(
        "txn_id", "amount", "txn_ts", "amount_cast", "txn_ts_cast"
    )


@query
def rejects_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejects(spark, sf_dir)


@query
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All outcomes in one table; clean and rejected rows have different columns."""
    classified = _stored_classified(spark, sf_dir)
    return quarantine.outcomes_by_name(quarantine.clean(classified), quarantine.rejects(classified))


@query
def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.rejects_by_reason(_rejects(spark, sf_dir))


@query
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@query
def referential_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject cascade with the account looked up in an account master with holes."""
    modulus, remainder = payments.MASTER_HOLES
    listed = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % modulus != remainder)
    master = payments.account_master(listed, "c_custkey")
    flagged = referential.flag_known_accounts(_parsed(spark, sf_dir), master, ids=_raw(spark, sf_dir))
    classified = quarantine.classify(flagged, RULES, unknown=referential.not_in_master())
    return quarantine.rejects(classified)


@query
def referential_rejects_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a master too large for one task, so that only unknown ids come back to the payments."""
    modulus, remainder = payments.MASTER_HOLES
    listed = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % modulus != remainder)
    master = payments.account_master(listed, "c_custkey")
    # One byte less than the master takes as a list; the ids that it lacks are far fewer.
    limit = referential.id_list_bytes(master) - 1
    flagged = referential.flag_known_accounts(_parsed(spark, sf_dir), master, limit, _raw(spark, sf_dir))
    classified = quarantine.classify(flagged, RULES, unknown=referential.not_in_master())
    return quarantine.rejects(classified)


@query
def unlabelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose id the labels do not list."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return referential.flag_known(documents, "doc_id", labels, "labelled").filter("NOT labelled")


@query
def silver_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = _stored_classified(spark, sf_dir)
    return reconcile.reconciliation(
        _raw(spark, sf_dir), quarantine.clean(classified), quarantine.rejects(classified)
    )


@query
def duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.duplicate_counts(_raw(spark, sf_dir))


# Gold


@query
def account_daily_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.daily_profile(_silver(spark, sf_dir))


@query
def trailing_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    baseline = days.with_baseline(days.daily_profile(_silver(spark, sf_dir)), RULES)
    return baseline.select(
        "account_id", "account_day", "max_amount", "avg_amount_30d_trailing", "prior_txn_count"
    )


@query
def account_day_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _account_day(spark, sf_dir)


@query
def gold_late_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account days built without some payments of two days, then brought up to date for these days."""
    silver = scratch_table(spark, _silver(spark, sf_dir), "silver")
    day, number = F.dayofmonth("account_day"), F.substring("txn_id", 2, 8).cast("long")
    late = day.isin(9, 17) & (number % 3 == 0)
    database = f"paylake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'lake')}'")
    name = f"{database}.gold_account_day"
    late_days.build_days(spark, silver.filter(~late), name, RULES)
    changed = [row["account_day"] for row in silver.filter(late).select("account_day").distinct().collect()]
    late_days.update_days(spark, silver, name, changed, RULES)
    return spark.table(name)


@query
def merchant_hour_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merchant_hour(spark, sf_dir)


@query
def supplier_day_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account-day profile for suppliers: parts as devices, prices as amounts."""
    sales = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("account_id"),
        F.to_date("l_shipdate").alias("account_day"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.col("l_partkey").alias("device_id"),
    )
    return days.account_day(sales, RULES).withColumnsRenamed(
        {"account_id": "supplier_id", "account_day": "ship_day", "distinct_devices": "distinct_parts"}
    )


# Questions


@query
def q_spend_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.spend_spikes(_account_day(spark, sf_dir))


@query
def q_spend_spikes_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = governance.conform(_account_day(spark, sf_dir), WAREHOUSE_ACCOUNT_DAY)
    return questions.spend_spikes_stored(stored, RULES)


@query
def q_spend_spikes_analyst(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = governance.masked_view(_account_day(spark, sf_dir), ["account_id"], governance.ANALYST_ROLE)
    return questions.spend_spikes(view)


@query
def q_device_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.device_bursts(_account_day(spark, sf_dir))


@query
def q_offhour_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.offhour_failure(_merchant_hour(spark, sf_dir), RULES)


@query
def q_offhour_failure_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = questions.audit_labels(RULES)
    return questions.offhour_failure(_merchant_hour(spark, sf_dir), RULES, labels)


@query
def hourly_failure_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounded here only, because engines differ in the last bits of a mean."""
    curve = questions.hourly_failure_curve(_merchant_hour(spark, sf_dir), RULES)
    return curve.withColumns({name: F.round(name, 6) for name in ("target_grp", "normal_grp")})


# Governance and audit


@query
def masked_accounts_analyst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.masked_view(_account_day(spark, sf_dir), ["account_id"], governance.ANALYST_ROLE)


@query
def masked_accounts_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.masked_view(_account_day(spark, sf_dir), ["account_id"], governance.CLEAR_ROLE)


@query
def masked_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.masked_view(_rejects(spark, sf_dir), ["account_id"], governance.ANALYST_ROLE)


@query
def warehouse_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.conform(_account_day(spark, sf_dir), WAREHOUSE_ACCOUNT_DAY)


@query
def warehouse_conform_merchant_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.conform(_merchant_hour(spark, sf_dir), WAREHOUSE_MERCHANT_HOUR)


@query
def warehouse_conform_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects as loaded. The load time differs per run, so only its presence is shown."""
    stamped = _rejects(spark, sf_dir).withColumn("_rejected_at", F.current_timestamp())
    loaded = governance.conform(stamped, WAREHOUSE_REJECTS)
    return loaded.withColumn("has_rejected_at", F.col("_rejected_at").isNotNull()).drop("_rejected_at")


@query
def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared rules checked on the three warehouse tables as loaded."""
    classified = _stored_classified(spark, sf_dir)
    silver = quarantine.clean(classified)
    rejected = quarantine.rejects(classified).withColumn("_rejected_at", F.current_timestamp())
    return governance.audit_warehouse(
        {
            "gold_account_day": governance.conform(days.account_day(silver, RULES), WAREHOUSE_ACCOUNT_DAY),
            "gold_merchant_hour": governance.conform(merchant_hour(silver), WAREHOUSE_MERCHANT_HOUR),
            "silver_rejects": governance.conform(rejected, WAREHOUSE_REJECTS),
        }
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return governance.split_load(spark, broken_lines(table(spark, sf_dir, "lineitem")), ORDER_LINES)


@query
def warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with broken values among them, as far as the declared table takes them."""
    return _order_lines(spark, sf_dir)[0]


@query
def warehouse_load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other order lines, each with all the rules that it breaks."""
    rejected = _order_lines(spark, sf_dir)[1]
    return rejected.withColumn(governance.FAILED_RULES, F.array_join(governance.FAILED_RULES, " "))


@query
def warehouse_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared rules checked on what was loaded: none is broken."""
    return governance.audit_constraints(_order_lines(spark, sf_dir)[0], ORDER_LINES)


@query
def order_line_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared rules checked on the order lines, which do break their key."""
    return governance.audit_constraints(table(spark, sf_dir, "lineitem"), ORDER_LINES)


@query
def layer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classified rows are written once; every count reads them from there."""
    classified = _stored_classified(spark, sf_dir)
    silver = quarantine.clean(classified)
    return reconcile.layer_metrics(
        _accounts(spark, sf_dir),
        _raw(spark, sf_dir),
        classified,
        days.account_day(silver, RULES),
        merchant_hour(silver),
    )


# Scalar functions


@query
def scalar_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    unit_price = F.try_divide(price.cast(MONEY), quantity.cast(MONEY))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.round(unit_price, 2).alias("unit_price"),
        F.round(price * F.col("l_discount"), 4).alias("discount_value"),
        F.round(price - quantity * 5, 2).alias("price_minus"),
        (F.col("l_orderkey") % 45).alias("bucket"),
        rounded_int(quantity / 3).alias("rounded_third"),
        F.round(F.exp(F.lit(6.2) + F.sin(F.col("l_orderkey").cast("double")) * 0.5), 2).alias("wave"),
        F.abs(F.col("l_partkey") - F.col("l_suppkey")).alias("key_distance"),
    )


@query
def scalar_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    shifted = F.date_add(F.to_date("o_orderdate"), (key % 45).cast("int"))
    return orders.select(
        "o_orderkey",
        padded_id("T", 8, key).alias("txn_id"),
        padded_id("DEV9", 6, F.col("o_custkey")).alias("device_id"),
        F.format_string(
            "%s %02d:%02d:00", F.date_format(shifted, "yyyy-MM-dd"), key % 24, key % 60
        ).alias("shifted_ts"),
    )


@query
def portable_hash_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", hash_bucket(F.col("c_name"), 100).alias("bucket")
    )
