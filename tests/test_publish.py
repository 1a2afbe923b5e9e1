"""Write, audit, publish: nothing that readers see changes before the checks hold, and never half-way."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from paylake.operators import governance, reconcile
from paylake.plans import medallion
from paylake.rules import EVENT_RULES
from paylake.schemas import RAW_PAYMENTS
from paylake.sources import lake
from paylake.sources.files import table, write_csv
from paylake.sources.payments import account_master, raw_payments

NAMES = (*medallion.PUBLISHED, "gold_account_day_data_analyst", "silver_rejects_fraud_ops")


@pytest.fixture(scope="module")
def raw_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    small = "/root/testdata/sf0.001"
    write_csv(raw_payments(table(spark, small, "events")), str(path / "txns.csv"))
    write_csv(account_master(table(spark, small, "customer"), "c_custkey"), str(path / "accounts.csv"))
    return str(path)


def shown(spark, database):
    """All rows of every published name, and the version it shows."""
    rows = {}
    for name in NAMES:
        df = spark.table(f"{database}.{name}")
        rows[name] = sorted(map(str, df.collect()))
    return rows, [lake.published_version(spark, f"{database}.{name}") for name in medallion.PUBLISHED]


@pytest.fixture
def built(spark, raw_dir, request):
    """A database with one published build, and a second one that is staged."""
    database = f"publish_{abs(hash(request.node.name)) % 10**9}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    report = medallion.run(spark, raw_dir, EVENT_RULES, database)
    return database, report, medallion.stage(spark, raw_dir, EVENT_RULES, database)


def rewrite(spark, name, changed):
    """Put other rows into a staged table."""
    spare = f"{name}_spare"
    changed.write.saveAsTable(spare)
    columns = ", ".join(f"`{column}`" for column in spark.table(name).columns)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    spark.sql(f"INSERT OVERWRITE {name} SELECT {columns} FROM {spare}")
    spark.sql(f"DROP TABLE {spare}")


def test_a_build_that_loses_a_row_changes_nothing(spark, raw_dir, built):
    database, _, build = built
    before = shown(spark, database)
    name = build.release.staged("silver_classified")
    whole = spark.table(name)
    least = whole.filter("disposition = 'clean'").agg(F.min("txn_id")).first()[0]
    rewrite(spark, name, whole.filter(F.col("txn_id") != least))
    with pytest.raises(ValueError, match="reconcile"):
        medallion.publish(build)
    assert shown(spark, database) == before
    build.release.discard()
    assert not spark.catalog.tableExists(name)
    assert shown(spark, database) == before
    assert medallion.run(spark, raw_dir, EVENT_RULES, database).balanced


def test_a_row_lost_and_another_invented_do_not_balance(spark, built):
    database, _, build = built
    before = shown(spark, database)
    name = build.release.staged("silver_classified")
    whole = spark.table(name)
    least = whole.filter("disposition = 'clean'").agg(F.min("txn_id")).first()[0]
    rewrite(spark, name, whole.withColumn("txn_id", F.when(F.col("txn_id") == least, "T99999999").otherwise(F.col("txn_id"))))
    counts = reconcile.reconciliation(*map(build.release.read, ("bronze_txns", "silver_txns", "silver_rejects"))).first()
    assert counts["bronze_rows"] - counts["duplicate_rows"] - counts["reject_rows"] == counts["clean_rows"]
    assert counts["raw_checksum"] != counts["kept_checksum"] and not counts["balanced"]
    with pytest.raises(ValueError, match="reconcile"):
        medallion.publish(build)
    assert shown(spark, database) == before


def test_a_broken_key_changes_nothing(spark, built):
    database, _, build = built
    before = shown(spark, database)
    name = build.release.staged("gold_account_day")
    rewrite(spark, name, spark.table(name).union(spark.table(name).limit(1)))
    with pytest.raises(ValueError, match="constraints are broken.*gold_account_day"):
        medallion.publish(build)
    assert shown(spark, database) == before


def test_staged_tables_are_published_in_one_version_and_an_interrupted_switch_is_finished(spark, built):
    database, report, build = built
    rows, versions = shown(spark, database)
    views = build.release.views
    build.release.views = dict(list(views.items())[:3])  # as if the driver had gone after three names
    build.release.publish()
    assert len(set(shown(spark, database)[1])) == 2
    build.release.views = views
    assert medallion.publish(build) == report
    assert set(shown(spark, database)[1]) == {build.release.version}
    timeless = lambda found: {k: v for k, v in found.items() if k.startswith("gold")}
    assert timeless(shown(spark, database)[0]) == timeless(rows) and set(versions) != {build.release.version}


def test_managed_tables_are_checked_before_they_are_overwritten(spark, raw_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS publish_managed")
    medallion.run(spark, raw_dir, EVENT_RULES, "publish_managed", silver_tables=True)
    before = spark.table("publish_managed.gold_account_day").count()
    build = medallion.stage(spark, raw_dir, EVENT_RULES, "publish_managed", silver_tables=True)
    name = build.release.staged("gold_account_day")
    rewrite(spark, name, spark.table(name).union(spark.table(name)))
    with pytest.raises(ValueError, match="constraints"):
        medallion.publish(build)
    assert spark.table("publish_managed.gold_account_day").count() == before


def test_old_versions_go_and_shown_ones_stay(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS publish_versions")
    for n in range(5):
        lake.replace_table(spark.range(n + 1).toDF("n"), "publish_versions.numbers", keep=2)
    kept = [r["tableName"] for r in spark.sql("SHOW TABLES IN publish_versions").collect() if "__v" in r["tableName"]]
    assert len(kept) == 2 and spark.table("publish_versions.numbers").count() == 5
    # An older version that another name shows outlasts newer ones.
    oldest = min(kept)
    version = oldest.split(lake.VERSION_MARK)[1]
    lake.save_view(spark, "publish_versions.kept", f"SELECT * FROM publish_versions.{oldest}", version)
    for n in range(3):
        lake.replace_table(spark.range(1).toDF("n"), "publish_versions.numbers", keep=1)
    assert spark.table("publish_versions.kept").count() == 4
    with pytest.raises(ValueError, match="exists as a table"):
        spark.range(1).write.saveAsTable("publish_versions.plain")
        lake.replace_table(spark.range(2).toDF("n"), "publish_versions.plain")


def test_readers_never_fail_and_never_see_a_mix(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS publish_readers")
    name = "publish_readers.gold_account_day"

    def write(batch):
        rows = spark.range(0, 4000 + batch, 1, 4).select("id", F.lit(batch).alias("batch"))
        lake.replace_table(rows, name, keep=4)

    write(0)
    seen, failed, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(tuple(spark.table(name).agg(F.count("*"), F.min("batch"), F.max("batch")).first()))
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    readers = [threading.Thread(target=read) for _ in range(2)]
    for reader in readers:
        reader.start()
    for batch in range(1, 9):
        write(batch)
    done.set()
    for reader in readers:
        reader.join()
    assert not failed
    assert len(seen) > 8 and {count - least for count, least, _ in seen} == {4000}
    assert all(least == most for _, least, most in seen) and len({least for _, least, _ in seen}) > 2


def test_checksums_are_free_of_order_and_of_copies(spark, payments):
    rows = payments(
        {"txn_id": "T1"}, {"txn_id": "T1", "amount": "11.00"}, {"txn_id": "T2", "amount": "NA"}, {"txn_id": None, "account_id": "A"},
        {"txn_id": None, "account_id": "A"}, {"txn_id": None, "account_id": None}, {"txn_id": "T3"},
    )
    from paylake.operators import quarantine
    from paylake.operators.dedup import distinct_payments

    classified = quarantine.classify(quarantine.parse(distinct_payments(rows)), medallion.Rules())
    clean, rejects = quarantine.clean(classified), quarantine.rejects(classified)
    first = reconcile.reconciliation(rows, clean, rejects).first()
    again = reconcile.reconciliation(rows.repartition(7), clean.repartition(3), rejects.repartition(2)).first()
    assert first == again and first["balanced"] and first["raw_checksum"] != "0"
    empty = rows.limit(0)
    none = reconcile.reconciliation(empty, clean.limit(0), rejects.limit(0)).first()
    assert none["balanced"] and none["raw_checksum"] == none["kept_checksum"] == "0"
    swapped = rejects.withColumn("account_id", F.when(F.col("account_id") == "A", "B").otherwise(F.col("account_id")))
    assert not reconcile.reconciliation(rows, clean, swapped).first()["balanced"]


@pytest.fixture(scope="module")
def guarded(spark, raw_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS guarded_private")
    spark.sql("CREATE DATABASE IF NOT EXISTS guarded_public")
    medallion.run(spark, raw_dir, EVENT_RULES, "guarded_private", published="guarded_public")
    return "guarded_private", "guarded_public"


def accounts_of(spark, public, name):
    return {r["account_id"] for r in spark.table(f"{public}.{name}").select("account_id").distinct().collect()}


def test_the_role_is_looked_up_when_the_view_is_read(spark, raw_dir, guarded):
    private, public = guarded
    user = spark.sql("SELECT session_user()").first()[0]
    # A user whom nobody has listed sees no clear id anywhere in the published database.
    for row in spark.sql(f"SHOW TABLES IN {public}").collect():
        df = spark.table(f"{public}.{row['tableName']}")
        for column in df.columns:
            assert df.filter(F.col(column).cast("string").startswith("ACC")).isEmpty(), (row["tableName"], column)
    masked = accounts_of(spark, public, "gold_account_day")
    assert masked and all(value.startswith("XXXXXXXX") for value in masked)
    governance.set_members(spark, private, [(user, governance.CLEAR_ROLE), ("else", governance.ANALYST_ROLE)])
    clear = accounts_of(spark, public, "gold_account_day")
    assert clear == accounts_of(spark, private, "gold_account_day")
    assert any(value.startswith("ACC") for value in accounts_of(spark, public, "silver_rejects"))
    # Another build keeps the members; taking the role away masks again.
    medallion.run(spark, raw_dir, EVENT_RULES, private, published=public)
    assert accounts_of(spark, public, "gold_account_day") == clear
    governance.set_members(spark, private, [(user, governance.ANALYST_ROLE)])
    assert accounts_of(spark, public, "gold_account_day") == masked
    plan = spark.table(f"{public}.gold_account_day").filter("is_device_burst")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_device_burst,true)" in plan


def test_replacing_the_mask_changes_every_view(spark, guarded):
    private, public = guarded
    spark.sql(f"CREATE OR REPLACE FUNCTION {public}.{governance.MASK}(value STRING) RETURNS STRING RETURN 'hidden'")
    assert accounts_of(spark, public, "gold_account_day") == accounts_of(spark, public, "silver_rejects") == {"hidden"}
    governance.create_mask(spark, public, private)
    assert "hidden" not in accounts_of(spark, public, "gold_account_day")
