"""Reports over the written lake tables. Each report is a small DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake.operators import governance, reconcile
from paylake.plans import questions
from paylake.plans.medallion import view_name
from paylake.rules import Rules
from paylake.schemas import WAREHOUSE_TABLES


def warehouse_views(
    spark: SparkSession, role: str, database: str | None = None
) -> dict[str, DataFrame]:
    """The published views of the three warehouse tables for ``role``."""

    def published(table: str) -> DataFrame:
        name = view_name(table, role)
        return spark.table(f"{database}.{name}" if database else name)

    return {declared.name: published(declared.name) for declared in WAREHOUSE_TABLES}


def answers(views: dict[str, DataFrame], rules: Rules) -> dict[str, DataFrame]:
    """The three business questions and the two breakdowns, asked of published views."""
    return {
        "spend_spikes": questions.spend_spikes(views["gold_account_day"]),
        "device_bursts": questions.device_bursts(views["gold_account_day"]),
        "offhour_failure": questions.offhour_failure(views["gold_merchant_hour"], rules),
        "hourly_failure_curve": questions.hourly_failure_curve(views["gold_merchant_hour"], rules),
        "rejects_by_reason": questions.rejects_by_reason(views["silver_rejects"]),
    }


def checks(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """Row conservation, layer counts and declared constraints of the written tables."""

    def read(name: str) -> DataFrame:
        return spark.table(f"{database}.{name}" if database else name)

    raw, classified = read("bronze_txns"), read("silver_classified")
    return {
        "reconciliation": reconcile.reconciliation(raw, read("silver_txns"), read("silver_rejects")),
        "layer_metrics": reconcile.layer_metrics(
            read("bronze_accounts"),
            raw,
            classified,
            read("gold_account_day"),
            read("gold_merchant_hour"),
        ),
        "constraints": governance.audit_warehouse(
            {declared.name: read(declared.name) for declared in WAREHOUSE_TABLES}
        ),
    }
