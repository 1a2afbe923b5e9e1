from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside or return; documents may have columns of these names.
CLASHING = [
    "score", "dedup", "contamination", "fp", "row_no", "before", "piece", "length", "sequence_id", "shard",
    "slot", "size", "blob", "path", "leaf", "line", "tokens", "template", "part", "content", "_place", "nth",
    "spans", "keep", "toxic", "tuning", "found",
]


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (doc_id, text) pairs."""

    def build(*texts, clashing: bool = False):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, SCHEMA)
        if clashing:
            df = df.select("*", *[F.lit(f"own {name}").alias(name) for name in CLASHING])
        return df.repartition(3)

    return build


@pytest.fixture
def odd_docs(docs):
    """Nulls in every column, empty and very long texts, repeated rows and ids, clashing column names."""
    long = " ".join(f"word{i % 977} pass" for i in range(30_000))
    line = "All of the rights in this long line of text are reserved by 17 owners and their many heirs"
    return docs(
        (1, "plain text here"), (1, "plain text here"), (1, "another text under one id"),
        (None, "a text without an id"), (None, "a text without an id"), (None, None), (2, None), (3, ""), (4, " \n\t "),
        (5, long), (6, "x" * 200_000), (7, f"{line}\nsomething of its own"), (8, f"{line}\nmore of its own text"),
        (9, "Ünïcödé wörds ﬁ 中文 \U0001f600 <|endoftext|>"), (-3, "plain text here"),
        clashing=True,
    )


@pytest.fixture
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    """Documents of the smallest tables, as a DataFrame and as (doc_id, text) rows."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id").collect()]
