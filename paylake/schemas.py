"""Column lists and types of every table in the lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw column names, in file order. Raw columns are always text.
ACCOUNT_COLUMNS = ["account_id", "bank", "home_city", "primary_device", "secondary_device"]
PAYMENT_COLUMNS = [
    "txn_id",
    "account_id",
    "merchant_id",
    "merchant_category",
    "txn_ts",
    "device_id",
    "status",
    "amount",
]
LINEAGE_COLUMNS = ["_source_file", "_ingested_at", "_row_hash"]
# The whole text of a line that does not have exactly the declared fields, else NULL.
MALFORMED = "_malformed_line"

MONEY = "decimal(18,2)"


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in columns])


RAW_ACCOUNTS = text_schema(ACCOUNT_COLUMNS)
RAW_PAYMENTS = text_schema(PAYMENT_COLUMNS)

# Declared schemas of the columnar input tables the queries read: no inference job,
# and a file with other types fails instead of shifting results.
SOURCE_TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = True
    max_chars: int | None = None


@dataclass(frozen=True)
class WarehouseTable:
    """Declared load target: by-name types plus the rules Spark itself does not enforce."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()


# Declared warehouse tables (column order, precision, keys).
WAREHOUSE_ACCOUNT_DAY = WarehouseTable(
    name="gold_account_day",
    fields=(
        Field("account_id", "string", max_chars=32),
        Field("account_day", "date"),
        Field("txns", "bigint"),
        Field("max_amount", MONEY),
        Field("avg_amount_30d_trailing", MONEY, required=False),
        Field("prior_txn_count", "bigint", required=False),
        Field("distinct_devices", "bigint"),
        Field("is_amount_spike", "boolean"),
        Field("is_device_burst", "boolean"),
    ),
    key=("account_id", "account_day"),
)
WAREHOUSE_MERCHANT_HOUR = WarehouseTable(
    name="gold_merchant_hour",
    fields=(
        Field("merchant_id", "string", max_chars=32),
        Field("hour_of_day", "int"),
        Field("txns", "bigint"),
        Field("failed_txns", "bigint"),
        Field("failure_rate", "decimal(8,4)"),
    ),
    key=("merchant_id", "hour_of_day"),
)
WAREHOUSE_REJECTS = WarehouseTable(
    name="silver_rejects",
    fields=(
        Field("txn_id", "string", required=False, max_chars=32),
        Field("account_id", "string", required=False, max_chars=32),
        Field("merchant_id", "string", required=False, max_chars=32),
        Field("txn_ts", "string", required=False, max_chars=64),
        Field("reject_reason", "string", required=False, max_chars=64),
        Field("_rejected_at", "timestamp_ntz", required=False),
    ),
)
# The order lines as a declared table: its key is not unique in the test data.
ORDER_LINES = WarehouseTable(
    name="lineitem",
    fields=(
        Field("l_orderkey", "bigint"),
        Field("l_linenumber", "int"),
        Field("l_partkey", "bigint"),
        Field("l_suppkey", "bigint"),
        Field("l_returnflag", "string", max_chars=1),
        Field("l_shipdate", "timestamp_ntz"),
    ),
    key=("l_orderkey", "l_linenumber"),
)
WAREHOUSE_TABLES = (WAREHOUSE_ACCOUNT_DAY, WAREHOUSE_MERCHANT_HOUR, WAREHOUSE_REJECTS)
