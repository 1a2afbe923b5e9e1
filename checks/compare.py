"""Run registered queries and their SQL side by side: python -m checks.compare SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.duckdb_sql import SQL
from paylake.plans.catalog import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def spark_rows(df: DataFrame) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(row) for row in df.select(*names).collect())


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return sorted(names), rows


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> list[str]:
    """Readable differences in columns, types or rows; empty when both agree."""
    df = QUERIES[name](spark, sf_dir)
    names, expected = sql_rows(con, SQL[name])
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} != {names}"]
    actual = spark_rows(df)
    found = [f"only in Spark: {row}" for row in list((actual - expected).elements())[:3]]
    found += [f"only in SQL: {row}" for row in list((expected - actual).elements())[:3]]
    kinds = [
        (column, {type(v).__name__ for v in mine if v is not None}, {type(v).__name__ for v in theirs if v is not None})
        for column, mine, theirs in zip(names, zip(*actual), zip(*expected))
    ]
    found += [f"types of {c}: {mine} != {theirs}" for c, mine, theirs in kinds if mine != theirs]
    return found


def main(sf_dir: str, *names: str) -> int:
    from paylake.session import local_session

    spark = local_session("paylake-compare", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.perf_counter()
        found = differences(spark, con, sf_dir, name)
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.perf_counter() - start:.2f}s", *found, sep="\n     ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
