"""Hot keys give right results, and the plans keep their shape."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from paylake.operators import account_day as days
from paylake.operators import quarantine
from paylake.operators.accounts import flag_known_accounts
from paylake.operators.dedup import distinct_payments
from paylake.operators.merchant_hour import merchant_hour
from paylake.plans import catalog
from paylake.plans.catalog import QUERIES
from paylake.rules import Rules

RULES = Rules()
ROWS = 9_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one id, one account, one merchant; all devices differ."""
    n = F.col("id")
    hot = n % 3 == 0
    return spark.range(0, ROWS, numPartitions=4).select(
        F.when(hot, "T00000000").otherwise(F.format_string("T%08d", n)).alias("txn_id"),
        F.when(n % 3 == 1, "ACC00000000").otherwise(F.format_string("ACC%08d", n % 50 + 1)).alias("account_id"),
        F.when(n % 3 == 1, "MER0000").otherwise(F.format_string("MER%04d", n % 60)).alias("merchant_id"),
        F.lit("MC00").alias("merchant_category"),
        F.format_string("2025-05-%02d %02d:00:00", n % 30 + 1, n % 24).alias("txn_ts"),
        F.format_string("DEV%07d", n).alias("device_id"),
        F.when(n % 5 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
        F.format_string("%d.25", n % 100).alias("amount"),
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_id_leaves_one_row_and_is_cut_before_the_shuffle(skewed):
    unique = distinct_payments(skewed)
    assert unique.count() == ROWS - ROWS // 3 + 1
    plan = plan_of(unique)
    assert plan.count("Exchange") == 1
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_hot_account_is_whole_and_partially_aggregated(skewed):
    silver = quarantine.clean(quarantine.classify(quarantine.parse(skewed), RULES))
    profile = days.daily_profile(silver)
    hot = profile.filter("account_id = 'ACC00000000'").agg(F.sum("txns"), F.sum("distinct_devices")).first()
    assert tuple(hot) == (ROWS // 3, ROWS // 3)
    plan = plan_of(profile)
    first_shuffle = plan.rindex("Exchange hashpartitioning(account_id")
    assert "partial_max" in plan[first_shuffle:]
    assert "device_id" in plan[first_shuffle : plan.index("\n", first_shuffle)]


def test_hot_merchant_is_whole_and_partially_aggregated(skewed):
    silver = quarantine.clean(quarantine.classify(quarantine.parse(skewed), RULES))
    hours = merchant_hour(silver)
    assert hours.filter("merchant_id = 'MER0000'").agg(F.sum("txns")).first()[0] >= ROWS // 3
    plan = plan_of(hours)
    assert plan.count("Exchange") == 1 and "partial_count" in plan[plan.index("Exchange") :]


@pytest.fixture
def skew_split(spark):
    """Joins by shuffle, with partitions counted as skewed from a few kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    }
    settings |= {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_large_master_is_joined_once_and_a_hot_account_is_split(spark, skewed, skew_split):
    """A third of the rows on one account, a tenth without any; no id of the master is copied."""
    rows = skewed.withColumn("account_id", F.expr("if(hash(device_id) % 10 = 0, NULL, account_id)"))
    accounts = skewed.select("account_id").distinct().filter("account_id <> 'ACC00000007'")
    small = flag_known_accounts(rows, accounts)
    large = flag_known_accounts(rows, accounts, broadcast_bytes=0)
    assert "BroadcastHashJoin" in plan_of(small) and "BroadcastHashJoin" not in plan_of(large)
    assert "explode" not in plan_of(large).lower()
    large.collect()
    plan = plan_of(large).split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true)" in plan
    hot = large.filter("account_id = 'ACC00000000'")
    assert hot.count() > ROWS // 4 and hot.filter("NOT account_known").isEmpty()
    assert large.filter("account_id IS NULL AND account_known").isEmpty()
    assert large.exceptAll(small).isEmpty() and small.exceptAll(large).isEmpty()


def test_rows_without_an_account_are_spread(spark, skewed, skew_split):
    lost = skewed.withColumn("account_id", F.lit(None).cast("string"))
    accounts = skewed.select("account_id").distinct()
    flagged = flag_known_accounts(lost, accounts, broadcast_bytes=0)
    sizes = Counter(r["part"] for r in flagged.withColumn("part", F.spark_partition_id()).collect())
    assert sum(sizes.values()) == ROWS and max(sizes.values()) < ROWS / 2
    assert flagged.filter("account_known").isEmpty()


@pytest.mark.parametrize("tasks", [1, 7])
def test_results_do_not_depend_on_the_layout(skewed, tasks):
    def gold(raw):
        unique = distinct_payments(raw)
        silver = quarantine.clean(quarantine.classify(quarantine.parse(unique), RULES))
        return days.account_day(silver, RULES)

    expected, actual = gold(skewed), gold(skewed.repartition(tasks, F.rand(1)))
    assert actual.exceptAll(expected).isEmpty() and expected.exceptAll(actual).isEmpty()


def test_the_classified_rows_take_one_deduplication(spark, sf_dir):
    plan = plan_of(catalog._classified(spark, sf_dir))
    assert plan.count("row_number(), 1, Final") == 1 and plan.count("Exchange") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_any_plan(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "CollectLimit"):
        assert operator not in plan, operator


@pytest.mark.parametrize(
    "name, columns",
    [
        ("supplier_day_baseline", {"l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"}),
        ("portable_hash_bucket", {"c_custkey", "c_name"}),
        ("unlabelled_documents", {"doc_id", "lang", "source"}),
    ],
)
def test_scans_read_only_the_needed_columns(spark, sf_dir, name, columns):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {part.split(":")[0] for part in schema.split(",")} == columns


@pytest.mark.parametrize("name", ["layer_metrics", "union_by_name", "constraint_audit", "silver_reconciliation"])
def test_several_readers_share_one_deduplication(spark, sf_dir, name):
    """Deduplication runs in the write of the classified rows; no reader repeats its sort and window."""
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "row_number()" not in plan and "WindowGroupLimit" not in plan
