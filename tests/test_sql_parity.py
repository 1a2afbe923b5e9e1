"""Every registered query against the same question in another SQL engine."""

import pytest

import __spark_entry__ as contract
from checks.compare import differences
from checks.duckdb_sql import SQL
from paylake.plans.catalog import QUERIES


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys() and SQL.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert differences(spark, duck, sf_dir, name) == []


def test_flagship_has_rows_and_a_stable_schema(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema
    assert first.count() == 365
