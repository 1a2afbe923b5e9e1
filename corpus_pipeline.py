"""The training-data pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake.llm.stages import (
    benchmark_decontamination,
    best_fit_packing,
    line_dedup,
    simhash_near_dedup,
    toxicity,
)
from paylake.session import reclaimed_scratch, remove_scratch, scratch_path

STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Language models, tries and tokenizers are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; the packed pieces of what they keep.

    Each stage is written and read again, and what it needed for that is removed once it is written, the
    stage before included; after an error all of it stays. Null and empty texts, repeated rows and columns of any name
    are treated as the stages say; an empty table gives no pieces.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with reclaimed_scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_scratch(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
