"""Parquet and CSV scans and the CSV sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from paylake.schemas import MALFORMED, SOURCE_TABLES

# Quoted fields double their quotes, an empty field is NULL.
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV scan with a declared schema.

    ``enforceSchema=false`` checks the header against the schema, so a file with
    reordered columns fails instead of loading values under the wrong names. A line with more or
    fewer fields than declared keeps what can be read and its whole text in ``_malformed_line``,
    which is NULL for all others. Select that column, or the scan prunes the check away.
    """
    checked = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType(), True)])
    options = {**CSV_OPTIONS, "enforceSchema": "false", "columnNameOfCorruptRecord": MALFORMED}
    return spark.read.schema(checked).options(**options).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan with inferred types. Costs one more pass; meant for profiling."""
    return spark.read.options(**CSV_OPTIONS, inferSchema="true").csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV folder with a header; blanks around values are kept."""
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode(mode).options(**CSV_OPTIONS, **kept).csv(path)
