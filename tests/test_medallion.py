"""The batch job end to end, from CSV files to tables and reports."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.compare import spark_rows, sql_rows
from checks.duckdb_sql import GOLD_COLUMNS, MERCHANT_COLUMNS, over
from paylake.__main__ import main
from paylake.operators.governance import ANALYST_ROLE, CLEAR_ROLE
from paylake.plans import audit, medallion
from paylake.plans.catalog import QUERIES
from paylake.rules import EVENT_RULES
from paylake.schemas import LINEAGE_COLUMNS, MALFORMED, PAYMENT_COLUMNS
from paylake.sources.files import table, write_csv
from paylake.sources.payments import account_master, raw_payments

DATABASE = "lake"


@pytest.fixture(scope="module")
def raw_dir(spark, sf_dir, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    write_csv(raw_payments(table(spark, sf_dir, "events")), str(path / "txns.csv"))
    write_csv(account_master(table(spark, sf_dir, "customer"), "c_custkey"), str(path / "accounts.csv"))
    return str(path)


@pytest.fixture(scope="module")
def report(spark, raw_dir):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    return medallion.run(spark, raw_dir, EVENT_RULES, DATABASE)


def test_report_matches_the_registered_metrics(spark, sf_dir, report):
    metrics = QUERIES["layer_metrics"](spark, sf_dir).first().asDict()
    written = report.as_dict()
    assert report.balanced
    assert {name: written[name] for name in metrics if name in written} == {
        name: value for name, value in metrics.items() if name in written
    }
    assert (written["unparseable_amount"], written["unknown_account"], written["timestamp_out_of_range"]) == (
        244,
        118,
        782,
    )


def test_written_counts_match_the_tables(spark, report):
    for name, count in report.as_dict().items():
        if spark.catalog.tableExists(f"{DATABASE}.{name}"):
            assert spark.table(f"{DATABASE}.{name}").count() == count, name
    assert spark.table(f"{DATABASE}.gold_account_day").count() == report.account_days
    assert spark.table(f"{DATABASE}.gold_merchant_hour").count() == report.merchant_hours


def test_table_schemas(spark, report):
    assert spark.table(f"{DATABASE}.bronze_txns").columns == [*PAYMENT_COLUMNS, *LINEAGE_COLUMNS, MALFORMED]
    silver = dict(spark.table(f"{DATABASE}.silver_txns").dtypes)
    assert list(silver) == [*PAYMENT_COLUMNS, *LINEAGE_COLUMNS, "account_day"]
    assert (silver["amount"], silver["txn_ts"], silver["account_day"]) == ("decimal(18,2)", "timestamp_ntz", "date")
    assert dict(spark.table(f"{DATABASE}.silver_rejects").dtypes) == {
        "txn_id": "string",
        "account_id": "string",
        "merchant_id": "string",
        "txn_ts": "string",
        "reject_reason": "string",
        "_rejected_at": "timestamp",
    }
    gold = dict(spark.table(f"{DATABASE}.gold_account_day").dtypes)
    assert gold["avg_amount_30d_trailing"] == "decimal(22,6)"


def test_tables_equal_the_lazy_queries(spark, sf_dir, report):
    rejected = spark.table(f"{DATABASE}.silver_rejects").drop("_rejected_at")
    lazy = QUERIES["rejects_cascade"](spark, sf_dir)
    assert rejected.exceptAll(lazy).isEmpty() and lazy.exceptAll(rejected).isEmpty()
    assert spark.table(f"{DATABASE}.silver_rejects").filter("_rejected_at IS NULL").isEmpty()


def test_silver_keeps_the_bronze_fingerprints(spark, report):
    columns = ["txn_id", "_source_file", "_ingested_at", "_row_hash"]
    silver = spark.table(f"{DATABASE}.silver_txns").select(*columns)
    assert silver.exceptAll(spark.table(f"{DATABASE}.bronze_txns").select(*columns)).isEmpty()


def test_silver_scan_reads_one_partition(spark, report):
    plan = spark.table(f"{DATABASE}.silver_txns").select("account_id")._jdf.queryExecution().toString()
    assert "disposition#" in plan and "PartitionFilters: [isnotnull(disposition" in plan


def test_second_run_overwrites(spark, raw_dir, report):
    assert medallion.run(spark, raw_dir, EVENT_RULES, DATABASE) == report


def test_layout_by_day_changes_no_rows(spark, raw_dir, report):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_by_day")
    assert medallion.run(spark, raw_dir, EVENT_RULES, "lake_by_day", silver_by_day=True) == report
    by_day, plain = spark.table("lake_by_day.silver_txns"), spark.table(f"{DATABASE}.silver_txns")
    assert by_day.schema == plain.schema
    left, right = by_day.drop("_ingested_at"), plain.drop("_ingested_at")
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    one_day = by_day.filter("account_day = DATE '2024-01-05'").select("account_id")
    assert "account_day#" in one_day._jdf.queryExecution().toString().split("PartitionFilters: ")[1]


def test_check_accounts_rejects_accounts_outside_the_master(spark, sf_dir, report, tmp_path):
    customers = table(spark, sf_dir, "customer").filter("c_custkey <> 8")
    write_csv(raw_payments(table(spark, sf_dir, "events")), str(tmp_path / "txns.csv"))
    write_csv(account_master(customers, "c_custkey"), str(tmp_path / "accounts.csv"))
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_checked")
    checked = medallion.run(spark, str(tmp_path), EVENT_RULES, "lake_checked", check_accounts=True)
    of_account = spark.table(f"{DATABASE}.silver_txns").filter("account_id = 'ACC00000008'").count()
    assert of_account > 0
    assert checked.silver_txns == report.silver_txns - of_account
    assert checked.bronze_txns - checked.duplicates == report.bronze_txns - report.duplicates


def test_skewed_build_equals_sql_over_the_same_files(spark, sf_dir, report, tmp_path):
    """A third of all rows on one id with differing content, a third on one account."""
    number = F.substring("txn_id", 2, 8).cast("long")
    skewed = raw_payments(table(spark, sf_dir, "events")).withColumns(
        {
            "account_id": F.when(number % 3 == 1, "ACC00000001").otherwise(F.col("account_id")),
            "txn_id": F.when(number % 3 == 0, "T00000000").otherwise(F.col("txn_id")),
        }
    )
    write_csv(skewed, str(tmp_path / "txns.csv"))
    write_csv(account_master(table(spark, sf_dir, "customer"), "c_custkey"), str(tmp_path / "accounts.csv"))
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_skewed")
    built = medallion.run(spark, str(tmp_path), EVENT_RULES, "lake_skewed")
    assert built.duplicates > built.bronze_txns // 4

    con = duckdb.connect()
    files = f"SELECT * FROM read_csv('{tmp_path}/txns.csv/*.csv', header = true, all_varchar = true)"
    gold = spark.table("lake_skewed.gold_account_day").withColumns(
        {name: F.col(name).cast("double") for name in ("max_amount", "avg_amount_30d_trailing")}
    )
    for written, layer, columns in (
        (gold, "gold", GOLD_COLUMNS),
        (spark.table("lake_skewed.gold_merchant_hour"), "merchant_gold", MERCHANT_COLUMNS),
        (spark.table("lake_skewed.silver_rejects").drop("_rejected_at"), "rejects", "*"),
    ):
        names, expected = sql_rows(con, over(layer, f"SELECT {columns} FROM {layer}", raw=files))
        assert sorted(written.columns) == names
        assert spark_rows(written) == expected


def test_reports_respect_the_role(spark, report):
    masked = audit.answers(audit.warehouse_views(spark, ANALYST_ROLE, DATABASE), EVENT_RULES)
    clear = audit.answers(audit.warehouse_views(spark, CLEAR_ROLE, DATABASE), EVENT_RULES)
    assert masked["spend_spikes"].count() == clear["spend_spikes"].count() == report.amount_spikes
    assert masked["device_bursts"].count() == report.device_bursts
    assert all(row["account_id"].startswith("XXXXXXXX") for row in masked["spend_spikes"].collect())
    assert not any(row["account_id"].startswith("XXXXXXXX") for row in clear["spend_spikes"].collect())
    assert masked["offhour_failure"].count() == 4
    assert masked["hourly_failure_curve"].count() == 24
    assert sum(row["rows"] for row in masked["rejects_by_reason"].collect()) == report.silver_rejects


def test_questions_push_their_filter_into_the_scan(spark, report):
    views = audit.warehouse_views(spark, ANALYST_ROLE, DATABASE)
    answers = audit.answers(views, EVENT_RULES)
    for name, flag in (("spend_spikes", "is_amount_spike"), ("device_bursts", "is_device_burst")):
        plan = answers[name]._jdf.queryExecution().executedPlan().toString()
        assert f"EqualTo({flag},true)" in plan
    plan = answers["device_bursts"]._jdf.queryExecution().executedPlan().toString()
    assert "max_amount" not in plan.split("ReadSchema: ")[1]


def test_checks_of_the_written_tables(spark, report):
    checks = audit.checks(spark, DATABASE)
    assert checks["reconciliation"].first()["balanced"]
    assert checks["layer_metrics"].first()["silver_txns"] == report.silver_txns
    for row in checks["constraints"].collect():
        assert (row["duplicate_keys"], row["null_violations"], row["length_violations"]) == (0, 0, 0)


def test_command_line_builds_tables_and_writes_reports(spark, raw_dir, report, tmp_path, capsys):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_cli")
    period = ["--valid-from", EVENT_RULES.valid_from, "--valid-to", EVENT_RULES.valid_to]
    period += ["--risk-merchants", EVENT_RULES.risk_merchant_from, EVENT_RULES.risk_merchant_to]
    together, alone = tmp_path / "together", tmp_path / "alone"
    build = ["build", raw_dir, "--database", "lake_cli", "--silver-tables", "--report", str(together)]
    main([*build, *period])
    printed = json.loads(capsys.readouterr().out)
    assert printed == report.as_dict()
    kinds = {t.name: t.tableType for t in spark.catalog.listTables("lake_cli") if not t.isTemporary}
    for name in ("silver_txns", "silver_rejects", "gold_account_day", "gold_merchant_hour"):
        assert kinds[name] == "MANAGED"
    assert spark.table("lake_cli.silver_rejects").count() == report.silver_rejects

    main(["report", str(alone), "--database", "lake_cli", *period])
    main(["report", str(alone), "--database", "lake_cli", *period])  # written over
    for out in (together, alone):
        spikes = spark.read.option("header", True).csv(f"{out}/spend_spikes")
        assert spikes.count() == report.amount_spikes
        assert spikes.filter("NOT startswith(account_id, 'XXXXXXXX')").isEmpty()
        groups = spark.read.option("header", True).csv(f"{out}/offhour_failure")
        assert groups.count() == 4
        checked = spark.read.option("header", True).csv(f"{out}/reconciliation").first()
        assert checked["balanced"] == "true"

    with pytest.raises(ValueError, match="exists as a table"):
        medallion.run(spark, raw_dir, EVENT_RULES, "lake_cli")


@pytest.mark.parametrize("lost", ["silver_txns", "silver_rejects"])
def test_rows_lost_or_doubled_on_the_way_are_found(spark, raw_dir, report, lost):
    """Rows are really taken out of, or put twice into, the written tables."""
    database = f"lake_{lost}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    medallion.run(spark, raw_dir, EVENT_RULES, database, silver_tables=True)
    assert medallion.verify(spark, database)["balanced"]
    whole = spark.table(f"{database}.{lost}")
    for name, changed in (("less", whole.filter("txn_id <> (SELECT min(txn_id) FROM {0})".format(f"{database}.{lost}"))), ("more", whole.union(whole.limit(1)))):
        changed.write.mode("overwrite").saveAsTable(f"{database}.{name}")
    for name in ("less", "more"):
        spark.sql(f"INSERT OVERWRITE {database}.{lost} SELECT * FROM {database}.{name}")
        with pytest.raises(ValueError, match="reconcile"):
            medallion.verify(spark, database)
        assert not audit.checks(spark, database)["reconciliation"].first()["balanced"]


def test_published_views_show_no_clear_id_to_analysts(spark, report):
    for table in ("gold_account_day", "silver_rejects"):
        clear = spark.table(f"{DATABASE}.{table}_fraud_ops")
        masked = spark.table(f"{DATABASE}.{table}_data_analyst")
        assert masked.count() == clear.count() > 0 and masked.columns == clear.columns
        assert masked.filter("NOT startswith(account_id, 'XXXXXXXX')").isEmpty()
        assert not clear.filter("startswith(account_id, 'ACC')").isEmpty()
    assert medallion.view_name("silver_rejects", "ANYONE") == "silver_rejects_data_analyst"


def test_malformed_lines_reach_the_rejects_and_their_text_stays(spark, sf_dir, report, tmp_path):
    write_csv(raw_payments(table(spark, sf_dir, "events")), str(tmp_path / "txns.csv"))
    write_csv(account_master(table(spark, sf_dir, "customer"), "c_custkey"), str(tmp_path / "accounts.csv"))
    lines = ["T00000001,ACC00000001", "T00000002,a,b,c,d,e,f,g,h"]
    (tmp_path / "txns.csv" / "more.csv").write_text("\n".join([",".join(PAYMENT_COLUMNS), *lines]) + "\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_malformed")
    built = medallion.run(spark, str(tmp_path), EVENT_RULES, "lake_malformed")
    assert built.malformed_line == 2 and built.silver_txns == report.silver_txns
    assert built.duplicates == report.duplicates and built.balanced
    kept = spark.table("lake_malformed.silver_classified").filter("reject_reason = 'malformed_line'")
    assert {r[MALFORMED] for r in kept.collect()} == set(lines)
