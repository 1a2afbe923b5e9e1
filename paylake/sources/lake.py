"""Tables and views of the lake.

A published name is a view on one version of its table. A new version is written under a name of its
own, and one replacement of the view makes it the current one. Readers see the old rows or the new
ones, never both and never none; those that started on the old version finish on it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Observation, functions as F

from paylake.session import scratch_path

VERSION_MARK = "__v"
# A view's version, and the published name that a versioned table was written for.
VERSION_PROPERTY = "paylake.version"
# Versions that stay readable, the current one included.
KEPT_VERSIONS = 2


def save_table(
    df: DataFrame, name: str, metrics: dict | None = None, partition_by: Sequence[str] = ()
) -> dict[str, int]:
    """Overwrite a managed table and return its row count and other metrics.

    The metrics are observed while the rows are written, so counting costs no
    second job. They sit right above the sink, in the result stage, where Spark
    counts each finished task once even if an executor is lost. Spark drops the old table
    first, so readers of the name fail until the new one is written; see ``Release``.
    """
    observed = Observation()
    exprs = [F.count(F.lit(1)).alias("rows")]
    exprs += [expr.alias(key) for key, expr in (metrics or {}).items()]
    writer = df.observe(observed, *exprs).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return dict(observed.get)


def scratch_table(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back, for several readers."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def check_replaceable(spark: SparkSession, name: str, as_view: bool) -> None:
    """Fail early when ``name`` exists as the other kind; nothing is dropped here."""
    if spark.catalog.tableExists(name):
        is_view = spark.catalog.getTable(name).tableType == "VIEW"
        if is_view != as_view:
            kind = "view" if is_view else "table"
            raise ValueError(f"{name} exists as a {kind}; drop or rename it first")


def save_view(spark: SparkSession, name: str, query: str, version: str | None = None) -> None:
    """Create or replace a view, in one step of the catalog."""
    mark = f" TBLPROPERTIES ('{VERSION_PROPERTY}' = '{version}')" if version else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name}{mark} AS {query}")


def new_version() -> str:
    """A label that sorts by time; versions of one moment differ in their tail."""
    return f"{datetime.now(UTC):%Y%m%d%H%M%S%f}{uuid.uuid4().hex[:6]}"


@dataclass
class Release:
    """Tables written together and published together, or not at all.

    ``stage`` writes a table under a versioned name that no reader knows. ``publish`` points the
    names at this version, one view each. Nothing published changes before that, so whatever is
    checked in between can still stop it, and an interrupted ``publish`` is finished by
    calling it again. A database has one writer at a time.
    """

    spark: SparkSession
    database: str | None = None
    version: str = field(default_factory=new_version)
    views: dict[str, str] = field(default_factory=dict)

    def named(self, table: str) -> str:
        return f"{self.database}.{table}" if self.database else table

    def staged(self, table: str) -> str:
        """The versioned name of a table."""
        return self.named(f"{table}{VERSION_MARK}{self.version}")

    def stage(
        self, df: DataFrame, table: str, metrics: dict | None = None, partition_by: Sequence[str] = ()
    ) -> dict[str, int]:
        """Write a version of ``table``, to be published under its name; returns the metrics."""
        counts = save_table(df, self.staged(table), metrics, partition_by)
        self.views[table] = f"SELECT * FROM {self.staged(table)}"
        return counts

    def define(self, name: str, query: str) -> None:
        """A name to be published as a view over staged tables."""
        self.views[name] = query

    def read(self, name: str) -> DataFrame:
        """What ``name`` will show once it is published."""
        return self.spark.sql(self.views[name])

    def check_names(self) -> None:
        for name in self.views:
            check_replaceable(self.spark, self.named(name), as_view=True)

    def publish(self, keep: int = KEPT_VERSIONS) -> None:
        """Switch every name to this version, then remove versions beyond the ``keep`` newest.

        A reader of a removed version fails, so ``keep`` bounds how many later builds a reader may outlast.
        """
        self.check_names()
        for name, query in self.views.items():
            save_view(self.spark, self.named(name), query, self.version)
        remove_old_versions(self.spark, self.database, keep)

    def discard(self) -> None:
        """Drop what was staged, for a release that will not be published."""
        for table in _versions(self.spark, self.database).get(self.version, []):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.named(table)}")


def _versions(spark: SparkSession, database: str | None) -> dict[str, list[str]]:
    """Versioned tables of a database by version."""
    found: dict[str, list[str]] = {}
    for row in spark.sql(f"SHOW TABLES{f' IN {database}' if database else ''}").collect():
        table, mark, version = row["tableName"].partition(VERSION_MARK)
        if mark and not row["isTemporary"]:
            found.setdefault(version, []).append(row["tableName"])
    return found


def published_version(spark: SparkSession, name: str) -> str | None:
    """The version that a published name shows."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == VERSION_PROPERTY).collect()
    return rows[0]["value"] if rows else None


def remove_old_versions(spark: SparkSession, database: str | None, keep: int = KEPT_VERSIONS) -> list[str]:
    """Drop the tables of all but the ``keep`` newest versions of each table; returns their names.

    A version that a view still shows is never dropped, however old.
    """
    prefix = f"{database}." if database else ""
    shown = {
        published_version(spark, f"{prefix}{row['viewName']}")
        for row in spark.sql(f"SHOW VIEWS{f' IN {database}' if database else ''}").collect()
        if not row["isTemporary"]
    }
    tables: dict[str, list[str]] = {}
    for version, names in _versions(spark, database).items():
        for name in names:
            tables.setdefault(name.partition(VERSION_MARK)[0], []).append(version)
    gone = []
    for table, versions in tables.items():
        for version in sorted(versions, reverse=True)[keep:]:
            if version not in shown:
                gone.append(f"{prefix}{table}{VERSION_MARK}{version}")
    for name in gone:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return gone


def replace_table(
    df: DataFrame,
    name: str,
    metrics: dict | None = None,
    partition_by: Sequence[str] = (),
    keep: int = KEPT_VERSIONS,
) -> dict[str, int]:
    """Create or replace a published table without a moment in which readers miss it."""
    database, _, table = name.rpartition(".")
    release = Release(df.sparkSession, database or None)
    check_replaceable(df.sparkSession, name, as_view=True)
    counts = release.stage(df, table, metrics, partition_by)
    release.publish(keep)
    return counts
