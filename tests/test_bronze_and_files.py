"""Landing, fingerprints, CSV scans and scalar expressions."""

import hashlib
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from paylake.functions.numbers import percent, ratio, rounded_int
from paylake.functions.text import hash_bucket, mask_tail, padded_id, row_fingerprint
from paylake.functions.times import try_instant
from paylake.operators import bronze, quarantine, reconcile
from paylake.operators.dedup import distinct_payments
from paylake.plans.catalog import QUERIES
from paylake.rules import Rules
from paylake.schemas import (
    ACCOUNT_COLUMNS,
    MALFORMED,
    PAYMENT_COLUMNS,
    RAW_ACCOUNTS,
    RAW_PAYMENTS,
    SOURCE_TABLES,
)
from paylake.session import scratch_path
from paylake.sources.files import read_csv, read_csv_inferred, table, write_csv


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).first()[0]


def test_fingerprint_is_plain_sha256(payments):
    row = bronze.with_fingerprint(payments({}), PAYMENT_COLUMNS).first()
    text = "||".join(row[name] for name in PAYMENT_COLUMNS)
    assert row["_row_hash"] == hashlib.sha256(text.encode()).hexdigest()


def test_null_marker_keeps_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    columns = ["x", "y", "z"]
    assert df.select(row_fingerprint(columns)).distinct().count() == 1
    assert df.select(row_fingerprint(columns, null_marker="\\N")).distinct().count() == 2


def test_land_adds_lineage(spark, tmp_path):
    path = tmp_path / "accounts.csv"
    path.write_text("account_id,bank,home_city,primary_device,secondary_device\nACC1,B,,D1,D2\n")
    row = bronze.land(read_csv(spark, str(path), RAW_ACCOUNTS), ACCOUNT_COLUMNS).first()
    assert row["home_city"] is None
    assert row["_source_file"].endswith("accounts.csv")
    assert row["_ingested_at"] is not None
    assert row["_row_hash"] == hashlib.sha256(b"ACC1||B||D1||D2").hexdigest()


def test_csv_keeps_quotes_delimiters_and_nulls(spark, tmp_path, payments):
    df = payments(
        {"status": 'say "hi", twice'}, {"amount": None}, {"device_id": "a\\b"}, {"status": "  both ", "amount": " 5 "}
    )
    write_csv(df, str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"), RAW_PAYMENTS)
    rows = sorted(back.collect(), key=lambda r: r["txn_id"])
    assert [(*r, None) for r in df.orderBy("txn_id").collect()] == [tuple(r) for r in rows]


def test_csv_is_written_over_only_on_request(spark, tmp_path, payments):
    path = str(tmp_path / "out")
    write_csv(payments({}, {}), path)
    with pytest.raises(Exception, match="(?i)exists"):
        write_csv(payments({}), path)
    write_csv(payments({}), path, mode="overwrite")
    assert read_csv(spark, path, RAW_PAYMENTS).count() == 1


def test_malformed_lines_keep_their_whole_text_and_are_rejected_as_such(spark, tmp_path):
    good = "T1,ACC00000001,MER0000,MC00,2025-05-02 10:00:00,DEV1,SUCCESS,5.00"
    bad = [
        good + ",ninth field",
        "T1,ACC00000001",
        "T2,ACC00000001,MER0000,MC00,2025-05-02 10:00:00,DEV1,FAILED, timeout,5.00",
    ]
    path = tmp_path / "txns.csv"
    path.write_text("\n".join([",".join(PAYMENT_COLUMNS), good, *bad, good]) + "\n")
    landed = bronze.land(read_csv(spark, str(path), RAW_PAYMENTS), PAYMENT_COLUMNS)
    assert landed.count() == 5
    assert {r[MALFORMED] for r in landed.collect()} == {None, *bad}
    classified = quarantine.classify(quarantine.parse(distinct_payments(landed)), Rules())
    assert sorted((r[MALFORMED] or "", r["reject_reason"]) for r in classified.collect()) == sorted(
        [("", None), *[(line, "malformed_line") for line in bad]], key=str
    )
    assert [r["txn_id"] for r in quarantine.clean(classified).collect()] == ["T1"]
    assert reconcile.duplicate_counts(landed).first()["duplicate_rows"] == 1


def test_offsets_in_times_are_dropped_not_applied(spark):
    found = one(spark, try_instant(F.col("v")).cast("string"), "2025-05-02 01:00:00+05:30")
    assert found == "2025-05-02 01:00:00"


def test_csv_with_reordered_header_fails(spark, tmp_path):
    path = tmp_path / "accounts.csv"
    path.write_text("bank,account_id,home_city,primary_device,secondary_device\nB,ACC1,C,D1,D2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(path), RAW_ACCOUNTS).collect()


def test_inferred_scan_types_numbers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,x\n2,y\n")
    df = read_csv_inferred(spark, str(path))
    assert dict(df.dtypes) == {"a": "int", "b": "string"}
    assert df.count() == 2


@pytest.mark.parametrize("name", SOURCE_TABLES)
def test_declared_schemas_equal_the_files(spark, sf_dir, name):
    path = f"{sf_dir}/{name}.parquet"
    assert table(spark, sf_dir, name).dtypes == spark.read.parquet(path).dtypes


def test_scratch_folder_is_the_configured_one(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(f"{shared}/") and first != second


def session_stub(master, conf=None, checkpoint_dir=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint_dir)
    return SimpleNamespace(conf=conf or {}, sparkContext=context)


def test_scratch_folder_is_never_machine_local_on_a_cluster():
    assert scratch_path(session_stub("yarn", {"spark.checkpoint.dir": "s3://a/b/"}), "x").startswith("s3://a/b/pay")
    assert scratch_path(session_stub("yarn", checkpoint_dir="hdfs:///c"), "x").startswith("hdfs:///c/")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session_stub("yarn"), "x")
    local = session_stub("local[2]", {"spark.sql.warehouse.dir": "/w/"})
    assert scratch_path(local, "x").startswith("/w/_scratch/")


def test_union_all_equals_the_single_scan_view(spark, sf_dir):
    view, union = QUERIES["raw_payments"](spark, sf_dir), QUERIES["raw_payments_union_all"](spark, sf_dir)
    assert view.exceptAll(union).isEmpty() and union.exceptAll(view).isEmpty()


@pytest.mark.parametrize("value, expected", [(0.5, 0), (1.5, 2), (2 / 3, 1), (599 / 3, 200), (-0.5, 0)])
def test_rounding_to_int(spark, value, expected):
    assert one(spark, rounded_int(F.col("v")), value, "double") == expected


def test_ratio_and_percent_survive_zero(spark):
    assert one(spark, ratio(F.lit(1), F.lit(3), 4)) == 0.3333
    assert one(spark, ratio(F.lit(1), F.lit(0), 4)) is None
    assert one(spark, percent(F.lit(1), F.lit(3))) == 33.33


@pytest.mark.parametrize(
    "number, text", [(0, "ACC00000000"), (123, "ACC00000123"), (1234567890, "ACC1234567890"), (None, None)]
)
def test_padded_id(spark, number, text):
    assert one(spark, padded_id("ACC", 8, F.col("v")), number, "long") == text


@pytest.mark.parametrize("value, masked", [("ACC00000123", "XXXXXXXX0123"), ("ab", "XXXXXXXXab"), (None, None)])
def test_mask(spark, value, masked):
    assert one(spark, mask_tail(F.col("v")), value) == masked


def test_hash_bucket_is_md5(spark):
    expected = int(hashlib.md5(b"Customer#1").hexdigest()[:8], 16) % 100
    assert one(spark, hash_bucket(F.col("v"), 100), "Customer#1") == expected
