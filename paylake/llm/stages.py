"""The operators as stages of the corpus pipeline: documents in, documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake.llm import decontamination, line_templates, packing, simhash
from paylake.llm import toxicity as toxic
from paylake.llm.ordering import small_side


def _free(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until it is none of the columns."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold.

    Null and empty texts have the score of no ratios; repeated rows stay repeated, columns of any name
    pass through, and an empty table gives an empty one.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = _free(docs, "score")
    scored = toxic.score_toxicity(spark, docs, labels, score)
    return scored.where(F.col(score) < toxic.THRESHOLD).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; what is left of copies goes.

    ``n_chars`` is counted anew where lines went. Null and empty texts stay, repeated rows stay repeated,
    columns of any name pass through, and an empty table gives an empty one.
    """
    column = _free(docs, "dedup")
    found = line_templates.drop_recurring_lines(spark, docs, column=column)
    text = F.col(f"{column}.text")
    n_chars = F.when(F.col(f"{column}.n_dropped") > 0, F.length(text)).otherwise(F.col("n_chars"))
    return found.where(F.col(f"{column}.kept")).select(
        *[
            text.alias(name) if name == "text" else n_chars.cast(kind).alias(name) if name == "n_chars" else F.col(name)
            for name, kind in docs.dtypes
        ]
    )


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, the one with the smallest id; one row of it where rows repeat.

    Documents without an id come last, null texts count as empty, columns of any name pass through,
    and an empty table gives an empty one. The list of documents that go, measured, is broadcast where it is
    small, so texts are not shuffled for it.
    """
    name, nth = _free(docs, "verdict"), _free(docs, "nth")
    told = simhash.verdicts(spark, docs.select("doc_id", "text"))
    several = not told.where("kept").isEmpty()
    listed = small_side(told, F.octet_length("content") + 64).select(F.struct("*").alias(name))
    content = F.md5(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].eqNullSafe(F.col(f"{name}.doc_id")) & (content == F.col(f"{name}.content"))
    joined = docs.join(listed, same, "left")
    alone = joined.where(F.col(name).isNull()).select(*docs.columns)
    if not several:
        return alone
    copies = Window.partitionBy(f"{name}.doc_id", f"{name}.content").orderBy(F.lit(0))
    once = joined.where(F.col(f"{name}.kept")).withColumn(nth, F.row_number().over(copies)).where(F.col(nth) == 1)
    return alone.union(once.select(*docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Null and empty texts have none and stay; repeated rows stay repeated, columns of any name pass
    through, and an empty table, of documents or of items, drops nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    column = _free(docs, "contamination")
    found = decontamination.find_benchmark(spark, docs, benchmark, column)
    return found.where(F.size(f"{column}.spans") == 0).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences.

    Null and empty texts are pieces of their end token alone; rows that repeat are packed each, ids may be
    null, other columns are not read, and an empty table gives no pieces.
    """
    return packing.pack_documents(spark, docs)
