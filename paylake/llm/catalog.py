"""Queries that apply the operators to whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paylake.llm import (
    bit_packing,
    chunk_fingerprints,
    decontamination,
    line_templates,
    minhash,
    packing,
    periodic_runs,
    secrets,
    sharding,
    simhash,
    source_divergence,
    token_counts,
    toxicity,
)
from paylake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    bit_packing.write_tokens(table(spark, sf_dir, "documents"), path)
    return bit_packing.read_documents(spark, path)


def op3_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_fingerprints.compare_with_edits(spark, table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.line_report(spark, table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(spark, table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark, table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(spark, table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), loop=True)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_token_counts,
        op2_bit_packing,
        op3_chunk_fingerprints,
        op4_decontamination,
        op5_toxicity,
        op6_line_dedup,
        op7_secret_scans,
        op8_sharding,
        op9_simhash,
        op10_best_fit_packing,
        op11_minhash,
        op12_source_divergence,
        op13_periodic_runs,
    )
}

SQL: dict[str, str] = {
    "op4_decontamination": decontamination.sql(),
    "op6_line_dedup": line_templates.sql(),
    "op7_secret_scans": secrets.sql(),
    "op11_minhash": minhash.sql(),
    "op12_source_divergence": source_divergence.sql(),
    "op13_periodic_runs": periodic_runs.sql(),
}
