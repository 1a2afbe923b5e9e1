"""Published views: role masks, declared types, key and NOT NULL audits, and the load that enforces them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paylake.functions.text import mask_tail, mask_tail_sql
from paylake.schemas import WAREHOUSE_TABLES, Field, WarehouseTable
from paylake.sources.lake import Release, replace_table, save_view, scratch_table

# Role names. Only the first one sees clear account ids.
CLEAR_ROLE = "FRAUD_OPS"
ANALYST_ROLE = "DATA_ANALYST"


# Counts of an audit row that must be zero.
VIOLATIONS = ("duplicate_keys", "null_violations", "length_violations")


def masked_view(df: DataFrame, columns: Sequence[str], role: str) -> DataFrame:
    """The table as ``role`` may see it."""
    if role == CLEAR_ROLE:
        return df
    return df.withColumns({name: mask_tail(F.col(name)) for name in columns})


def conform(df: DataFrame, table: WarehouseTable) -> DataFrame:
    """Project to the declared columns by name, so column order cannot mix values up."""
    return df.select(*[F.col(field.name).cast(field.type).alias(field.name) for field in table.fields])


def audit_constraints(df: DataFrame, table: WarehouseTable) -> DataFrame:
    """One row: how often the declared key, NOT NULL and length rules are broken.

    The key check counts rows per key first, so NULL and length tests ride on the
    same aggregation and a repeated key is reduced before the shuffle. A table without
    a key is counted as a whole.
    """
    required = [field.name for field in table.fields if field.required]
    bounded = [field for field in table.fields if field.max_chars is not None]
    nulls = sum((F.col(name).isNull().cast("int") for name in required), F.lit(0))
    too_long = sum(
        (F.coalesce((F.length(f.name) > f.max_chars).cast("int"), F.lit(0)) for f in bounded),
        F.lit(0),
    )
    per_key = df.groupBy(*table.key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(nulls).alias("null_values"),
        F.sum(too_long).alias("long_values"),
    )
    repeated = F.count_if(F.col("n") > 1) if table.key else F.lit(0).cast("long")
    return per_key.agg(
        F.lit(table.name).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        repeated.alias("duplicate_keys"),
        F.coalesce(F.sum("null_values"), F.lit(0)).alias("null_violations"),
        F.coalesce(F.sum("long_values"), F.lit(0)).alias("length_violations"),
    )


def _declared_select(table: WarehouseTable, source: str, columns: Sequence[str], mask: Callable[[str], str]) -> str:
    """SELECT of all declared columns by name and type, with ``mask`` around some."""
    fields = []
    for field in table.fields:
        value = f"CAST({field.name} AS {field.type})"
        fields.append(f"{mask(value) if field.name in columns else value} AS {field.name}")
    return f"SELECT {', '.join(fields)} FROM {source}"


def masked_select(table: WarehouseTable, source: str, columns: Sequence[str], role: str) -> str:
    """SELECT of a published view: declared types, and ids masked unless the role sees them."""
    return _declared_select(table, source, columns, str if role == CLEAR_ROLE else mask_tail_sql)


# Names in the private and in the published database.
MEMBERS = "role_members"
MASK = "mask_account"


def set_members(spark: SparkSession, database: str, members: Sequence[tuple[str, str]]) -> None:
    """Write who has which role, as (user, role) pairs, over what was written before; readers miss no moment."""
    rows = spark.createDataFrame([tuple(pair) for pair in members], "member string, role string")
    replace_table(rows.coalesce(1), f"{database}.{MEMBERS}")


def create_mask(spark: SparkSession, published: str, database: str) -> None:
    """The mask as a SQL function of the catalog, in the published database.

    It asks the member table of the private ``database`` for the session's user each time a query runs:
    members of the clear role see the value, anyone else, unknown users included, its end. Views
    name the function and do not hold its text, so replacing it changes all of them.
    """
    listed = f"SELECT count(*) > 0 FROM {database}.{MEMBERS} WHERE member = session_user() AND role = '{CLEAR_ROLE}'"
    spark.sql(
        f"CREATE OR REPLACE FUNCTION {published}.{MASK}(value STRING) RETURNS STRING "
        f"RETURN CASE WHEN ({listed}) THEN value ELSE {mask_tail_sql('value')} END"
    )


def publish_guarded(spark: SparkSession, published: str, database: str, columns: Sequence[str] = ("account_id",)) -> None:
    """One view for each warehouse table in ``published``, the same name for all roles.

    The database holds these views and the mask only. ``database``, with the tables, is to be closed to
    analysts by the catalog's or the store's own permissions. Without a member table everyone is masked.
    """
    if not spark.catalog.tableExists(f"{database}.{MEMBERS}"):
        set_members(spark, database, [])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {published}")
    create_mask(spark, published, database)
    for declared in WAREHOUSE_TABLES:
        query = _declared_select(
            declared, f"{database}.{declared.name}", columns, lambda value: f"{published}.{MASK}({value})"
        )
        save_view(spark, f"{published}.{declared.name}", query)


# The load: declared types, NOT NULL, lengths and keys enforced row by row.

FAILED_RULES = "failed_rules"


def _typed(field: Field) -> Column:
    return F.col(field.name).try_cast(field.type)


def _failed_rules(table: WarehouseTable) -> Column:
    """The rules that a row breaks by itself, field by field in declared order."""
    tests = []
    for field in table.fields:
        value = F.col(field.name)
        tests.append(F.when(value.isNotNull() & _typed(field).isNull(), F.lit(f"type:{field.name}")))
        if field.required:
            tests.append(F.when(value.isNull(), F.lit(f"null:{field.name}")))
        if field.max_chars is not None:
            tests.append(F.when(F.length(value.cast("string")) > field.max_chars, F.lit(f"length:{field.name}")))
    return F.array_compact(F.array(*tests))


def split_load(spark: SparkSession, df: DataFrame, table: WarehouseTable) -> tuple[DataFrame, DataFrame]:
    """What of ``df`` a declared table takes, with its types, and what it rejects.

    Columns go by name; others of ``df`` are not read, and a declared one that it lacks is an error. One value
    that does not fit never ends the load: rejects have the declared columns as text and in ``failed_rules``
    every rule they break. A key is taken once, by the first of its rows in the order of the other columns;
    the rest is rejected as a repeated key. Rows that break a rule of their own do not count for that.

    Rows are written once with their verdict. Keys are counted with one partial aggregation, and only repeated
    keys come back to the rows.
    """
    names = [field.name for field in table.fields]
    checked = df.select(*names).withColumn(FAILED_RULES, _failed_rules(table))
    checked = scratch_table(spark, checked.withColumn("_row", F.monotonically_increasing_id()), "checked")
    text = [F.col(name).cast("string").alias(name) for name in names]
    typed = [_typed(field).alias(field.name) for field in table.fields]
    good = checked.filter(F.size(FAILED_RULES) == 0)
    bad = checked.filter(F.size(FAILED_RULES) > 0).select(*text, FAILED_RULES)
    if not table.key:
        return good.select(*typed), bad
    others = [name for name in names if name not in table.key]
    keyed = good.select(*typed, F.struct(*text).alias("_text"), "_row")
    first = F.min(F.struct(*others, "_text", "_row")).alias("_first")
    repeated = keyed.groupBy(*table.key).agg(F.count(F.lit(1)).alias("_n"), first).filter("_n > 1")
    repeated = repeated.select(*[F.col(name).alias(f"_{name}") for name in table.key], F.col("_first._row").alias("_kept"))
    repeated = scratch_table(spark, repeated, "repeated-keys")
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in table.key]
    told = keyed.join(repeated, same, "left").withColumn(
        "_again", F.col("_kept").isNotNull() & (F.col("_kept") != F.col("_row"))
    )
    rule = F.array(F.lit(f"key:{','.join(table.key)}")).alias(FAILED_RULES)
    return told.filter("NOT _again").select(*names), bad.union(told.filter("_again").select("_text.*", rule))


def stage_load(release: Release, df: DataFrame, table: WarehouseTable) -> dict[str, int]:
    """Load ``df`` into the next version of a declared table, and what it rejects into ``<table>_load_rejects``."""
    taken, rejected = split_load(release.spark, df, table)
    counts = release.stage(taken, table.name)
    return {"loaded": counts["rows"], "rejected": release.stage(rejected, f"{table.name}_load_rejects")["rows"]}


def audit_warehouse(tables: dict[str, DataFrame]) -> DataFrame:
    """Constraint audits of all declared tables, one row each."""
    audits = [audit_constraints(tables[declared.name], declared) for declared in WAREHOUSE_TABLES]
    union = audits[0]
    for audit in audits[1:]:
        union = union.unionByName(audit)
    return union
