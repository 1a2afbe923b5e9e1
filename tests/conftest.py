from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import connect  # noqa: E402
from paylake.schemas import RAW_PAYMENTS  # noqa: E402
from paylake.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = local_session(
        "paylake-tests",
        8,
        "8g",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(work / "warehouse"),
            "spark.checkpoint.dir": str(work / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(TESTDATA / "sf0.01")


@pytest.fixture(scope="session")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture
def payments(spark):
    """Build raw payments from dicts; fields left out get a clean default."""

    def build(*rows: dict):
        clean = {
            "account_id": "ACC00000001",
            "merchant_id": "MER0000",
            "merchant_category": "MC00",
            "txn_ts": "2025-05-02 10:00:00",
            "device_id": "DEV0000001",
            "status": "SUCCESS",
            "amount": "10.00",
        }
        full = [{"txn_id": f"T{i:08d}", **clean, **row} for i, row in enumerate(rows)]
        return spark.createDataFrame(
            [tuple(row[name] for name in RAW_PAYMENTS.names) for row in full], RAW_PAYMENTS
        )

    return build


@pytest.fixture
def daily(spark):
    """Build an account-day profile from (account, day, max_amount, devices) tuples."""

    def build(*rows):
        return spark.createDataFrame(
            [(a, d, 1, None if m is None else Decimal(m), n) for a, d, m, n in rows],
            "account_id string, account_day date, txns long, max_amount decimal(18,2), "
            "distinct_devices long",
        )

    return build


@pytest.fixture
def day():
    def make(offset: int) -> date:
        return date.fromordinal(date(2025, 5, 1).toordinal() + offset)

    return make
