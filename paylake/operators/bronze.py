"""Landing: keep every raw column as text, add lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from paylake.functions.text import row_fingerprint
from paylake.schemas import MALFORMED
from paylake.sources.quoted import FILE


def with_fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumn("_row_hash", row_fingerprint(columns))


def land(scan: DataFrame, columns: Sequence[str]) -> DataFrame:
    """File scan to bronze: raw columns, source file, ingest time, fingerprint, malformed text."""
    return scan.select(
        *columns,
        F.col(FILE if FILE in scan.columns else "_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
        row_fingerprint(columns).alias("_row_hash"),
        MALFORMED,
    )
