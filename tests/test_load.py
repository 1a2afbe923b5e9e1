"""The enforced load against rules checked row by row, and the account check over all of its ways."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from paylake.operators import governance
from paylake.operators.accounts import ENTRY_BYTES, flag_known, id_list_bytes
from paylake.schemas import Field, WarehouseTable
from paylake.sources.lake import Release

DECLARED = WarehouseTable(
    name="loads",
    fields=(
        Field("id", "bigint"),
        Field("day", "date"),
        Field("amount", "decimal(6,2)", required=False),
        Field("name", "string", required=False, max_chars=3),
    ),
    key=("id", "day"),
)
SCHEMA = "name string, id string, amount string, day string, other int"


def rows(spark, *values):
    return spark.createDataFrame([(name, id_, amount, day, 1) for id_, day, amount, name in values], SCHEMA).repartition(3)


def test_each_rule_and_all_of_them_at_once(spark):
    df = rows(
        spark,
        ("1", "2024-01-01", "1.50", "abc"),
        ("2", "2024-01-01", "99999.99", "abc"),  # overflows
        ("3", "2024-02-30", None, "abcd"),
        (None, None, "x", "ü中文"),
        ("x", "2024-01-01", "1", None),
        ("4", "2024-01-01", None, None),
    )
    taken, rejected = governance.split_load(spark, df, DECLARED)
    assert [(r["id"], str(r["day"]), r["amount"], r["name"]) for r in taken.orderBy("id").collect()][1] == (
        4, "2024-01-01", None, None,
    )
    assert dict(taken.dtypes) == {"id": "bigint", "day": "date", "amount": "decimal(6,2)", "name": "string"}
    found = Counter((r["id"], *r[governance.FAILED_RULES]) for r in rejected.collect())
    assert found == Counter(
        [("2", "type:amount"), ("3", "type:day", "length:name"), (None, "null:id", "null:day", "type:amount"), ("x", "type:id")]
    )
    assert rejected.columns == ["id", "day", "amount", "name", governance.FAILED_RULES]


def test_repeated_keys_keep_their_first_row(spark):
    hot = [("7", "2024-01-01", str(n), "a") for n in range(300, 0, -1)]
    same = [("8", "2024-01-01", "5", "b")] * 4
    broken = [("9", "2024-01-01", "oops", "c"), ("9", "2024-01-01", "2", "c")]
    taken, rejected = governance.split_load(spark, rows(spark, *hot, *same, *broken, ("6", "2024-01-02", None, None)), DECLARED)
    assert sorted((r["id"], r["amount"]) for r in taken.filter("id > 6").collect()) == [(7, 1), (8, 5), (9, 2)]
    counts = Counter((r["id"], *r[governance.FAILED_RULES]) for r in rejected.collect())
    assert counts == Counter({("7", "key:id,day"): 299, ("8", "key:id,day"): 3, ("9", "type:amount"): 1})
    audit = governance.audit_constraints(taken, DECLARED).first()
    assert all(audit[name] == 0 for name in governance.VIOLATIONS)


def test_empty_and_keyless_tables(spark):
    taken, rejected = governance.split_load(spark, rows(spark, ("1", "2024-01-01", None, None)).limit(0), DECLARED)
    assert taken.isEmpty() and rejected.isEmpty()
    keyless = WarehouseTable("free", DECLARED.fields)
    twice = rows(spark, *[("1", "2024-01-01", None, None)] * 2, ("z", None, None, None))
    taken, rejected = governance.split_load(spark, twice, keyless)
    assert taken.count() == 2 and rejected.count() == 1


def test_loads_are_staged_and_published_like_other_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loads")
    release = Release(spark, "loads")
    df = rows(spark, ("1", "2024-01-01", "1", "a"), ("1", "2024-01-01", "2", "a"), ("2", "bad", "1", "a"))
    assert governance.stage_load(release, df, DECLARED) == {"loaded": 1, "rejected": 2}
    assert not spark.catalog.tableExists("loads.loads")
    release.publish()
    assert spark.table("loads.loads").count() == 1 and spark.table("loads.loads_load_rejects").count() == 2


def exchanges_of(df, column):
    """Shuffles in the final plan that carry ``column``."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.find("== Final Plan ==") : plan.find("== Initial Plan ==")] if "== Final Plan ==" in plan else plan
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line], plan


@pytest.fixture
def payments_and_master(spark):
    hot = F.when(F.col("id") % 3 == 0, "A1").when(F.col("id") % 7 == 1, None)
    rows = spark.range(3000).select(
        "id", hot.otherwise(F.concat(F.lit("A"), (F.col("id") % 200).cast("string"))).alias("account_id"), F.lit(1).alias("_x")
    )
    master = spark.range(20_000).where("id % 50 <> 9").select(F.concat(F.lit("A"), F.col("id").cast("string")).alias("account_id"))
    return rows, master.union(master.limit(5)).union(spark.createDataFrame([(None,)], "account_id string"))


def test_all_ways_of_the_account_check_agree(spark, payments_and_master):
    rows, master = payments_and_master
    size = id_list_bytes(master)
    flagged = {
        limit: Counter(map(tuple, flag_known(rows, "account_id", master, "known", limit).collect()))
        for limit in (size, size - 1, 4 * (ENTRY_BYTES + 4), 0)
    }
    listed = {r["account_id"] for r in master.collect()} - {None}
    expected = Counter((r["id"], r["account_id"], 1, r["account_id"] in listed) for r in rows.collect())
    assert all(found == expected for found in flagged.values())
    assert sum(n for row, n in expected.items() if not row[3]) > 300


def test_a_large_master_does_not_shuffle_the_payments(spark, payments_and_master):
    rows, master = payments_and_master
    limit = id_list_bytes(master) - 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found, plan = exchanges_of(flag_known(rows, "account_id", master, "known", limit), "_x")
        assert found == [] and "BroadcastHashJoin" in plan and "unknown-ids" in plan
        found, plan = exchanges_of(flag_known(rows, "account_id", master, "known", 0), "_x")
        assert found and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ids_may_come_from_a_cheaper_table(spark, payments_and_master):
    rows, master = payments_and_master
    limit = id_list_bytes(master) - 1
    direct = flag_known(rows, "account_id", master, "known", limit)
    wider = rows.select("account_id").union(spark.createDataFrame([("elsewhere",)], "account_id string"))
    other = flag_known(rows, "account_id", master, "known", limit, ids=wider)
    assert Counter(map(tuple, direct.collect())) == Counter(map(tuple, other.collect()))
