"""Counts worked out by hand for the test tables; they must not drift."""

import pytest

from paylake.plans.catalog import QUERIES

EXPECTED = {
    "sf0.001": {
        "bronze_txns": 1_011,
        "silver_rejects": 112,
        "silver_txns": 888,
        "account_days": 365,
        "amount_spikes": 0,
        "device_bursts": 119,
        "merchant_hours": 603,
    },
    "sf0.01": {
        "bronze_txns": 10_103,
        "silver_rejects": 1_144,
        "silver_txns": 8_856,
        "account_days": 3_676,
        "amount_spikes": 8,
        "device_bursts": 1_249,
        "merchant_hours": 960,
    },
}
REASONS = {
    "sf0.001": {"unparseable_amount": 25, "unknown_account": 12, "timestamp_out_of_range": 75},
    "sf0.01": {"unparseable_amount": 244, "unknown_account": 118, "timestamp_out_of_range": 782},
}


@pytest.mark.parametrize("sf", EXPECTED)
def test_layer_counts(spark, sf):
    row = QUERIES["layer_metrics"](spark, f"/root/testdata/{sf}").first().asDict()
    assert {name: row[name] for name in EXPECTED[sf]} == EXPECTED[sf]
    assert row["bronze_txns"] - row["duplicates"] - row["silver_rejects"] == row["silver_txns"]


@pytest.mark.parametrize("sf", REASONS)
def test_reject_counts(spark, sf):
    rows = QUERIES["rejects_by_reason"](spark, f"/root/testdata/{sf}").collect()
    assert {row["reject_reason"]: row["rows"] for row in rows} == REASONS[sf]
    counts = [row["rows"] for row in rows]
    assert counts == sorted(counts, reverse=True)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_rows_are_conserved(spark, sf):
    assert QUERIES["silver_reconciliation"](spark, f"/root/testdata/{sf}").first()["balanced"]
