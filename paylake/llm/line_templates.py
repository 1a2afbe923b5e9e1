"""Line dedup by a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and its leading tokens; tokens with digits are
variable from the start. Inside a leaf, a later token stays part of the template where enough
documents share it at that place, and is generalised to a variable field where they do not. Lines
of templates that recur across documents are dropped, but for the first such line.

What makes a template recur is its constant mass: the weight of its constant tokens times its documents.
Numbers do not count against it, so forms and logs full of them are found; words that vary do, so prose
that only begins alike is not.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import arrow, ordering
from paylake.llm.ordering import small_side, stored

FIELD = "<*>"
# Text that is parsed at once; its tokens take some ten times as much, and workers serve later stages too.
SLICE_BYTES = 2 << 20
# Tokens are what stands between white space; these are the characters that Unicode counts as such.
SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


@dataclass(frozen=True)
class Rules:
    depth: int = 4  # leading tokens of the tree's path
    token_chars: int = 8  # a token weighs one for each of so many characters, and one at least
    min_weight: int = 3  # lines of less weight are never dropped
    min_docs: int = 2  # documents that share a token or a template
    min_mass: int = 100  # documents times weight of the constant tokens of a recurring template
    min_constant: float = 0.8  # share of constant tokens among a template's tokens without digits
    min_constant_weight: int = 2  # weight of a template's constant tokens


LEAVES = pa.schema(
    [("doc_id", pa.int64()), ("content", pa.string()), ("line_no", pa.int32()), ("leaf", pa.int64()), ("weight", pa.int32())]
)
FORMS = pa.schema([*LEAVES, pa.field("form", pa.string())])
_DIGIT = re.compile("[0-9]")


def _masked(tokens: list[str]) -> str:
    """Tokens in a row, those with a digit as variable fields."""
    joined = " ".join(tokens)
    if not _DIGIT.search(joined):
        return joined
    return " ".join(FIELD if _DIGIT.search(token) else token for token in tokens)


def _lines(docs: DataFrame, rules: Rules, forms: bool, only: Broadcast | None = None) -> DataFrame:
    """Lines that weigh enough, with a hash of their leaf; with ``forms`` also their masked tokens.

    A document is its id and the digest of its text. ``only`` is a sorted array of the leaves asked for.
    """
    schema = FORMS if forms else LEAVES

    def parse(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, numbers, leaves, weights, found = [], [], [], [], []
        digest, chars = xxhash.xxh64_intdigest, rules.token_chars
        for i, text in enumerate(batch.column("text").to_pylist()):
            for number, line in enumerate(text.split("\n") if text else ()):
                tokens = line.split()
                weight = len(tokens)
                # Few lines have a token that weighs more than one.
                if len(line) >= 2 * chars and len(max(tokens, key=len, default="")) >= 2 * chars:
                    weight = sum(max(1, len(token) // chars) for token in tokens)
                if weight < rules.min_weight:
                    continue
                lead = _masked(tokens[: rules.depth])
                rows.append(i)
                numbers.append(number)
                leaves.append(digest(f"{len(tokens)} {lead}") - (1 << 63))
                weights.append(weight)
                if forms:
                    found.append(line)  # its tokens again later, as few lines are asked for
        rows, leaves = np.array(rows, np.int64), np.array(leaves, np.int64)
        kept = np.arange(len(rows))
        if only is not None:
            place = np.searchsorted(only.value, leaves)
            kept = np.flatnonzero(only.value.take(place, mode="clip") == leaves) if len(only.value) else kept[:0]
        return arrow.table(
            schema,
            doc_id=batch.column("doc_id").take(pa.array(rows[kept])),
            content=batch.column("content").take(pa.array(rows[kept])),
            line_no=pa.array(np.array(numbers, np.int32)[kept]),
            leaf=pa.array(leaves[kept]),
            weight=pa.array(np.array(weights, np.int32)[kept]),
            form=[_masked(found[i].split()) for i in kept.tolist()] if forms else None,
        )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("content"), "text")
    return arrow.map_slices(source, parse, schema, limit=SLICE_BYTES)


def _lines_of(spark: SparkSession, docs: DataFrame, rules: Rules, leaves: DataFrame) -> DataFrame:
    """Masked lines of the given leaves (stored), picked while parsing where the measured leaves are few."""
    if leaves.count() * 8 <= ordering.BROADCAST_BYTES:
        asked = spark.sparkContext.broadcast(np.sort(leaves.toArrow().column("leaf").to_numpy()))
        return _lines(docs, rules, True, asked)
    return _lines(docs, rules, True).join(leaves, "leaf", "left_semi")


def recurring_lines(spark: SparkSession, docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Every line (doc_id, content, line_no) of a recurring template, with ``template`` and ``first``.

    Leaves whose documents and heaviest line could not reach ``min_mass`` are left out before any token is
    looked at. A leaf is known by 64 bits of a hash of its path. Equal lines are merged first, so a line
    that a third of all documents share is counted by partial sums. Tokens are counted by leaf, place and
    token with partial sums too, so a leaf of very many forms is spread over its tokens; only tokens that
    vary come back to their forms.
    """
    leaves = (
        _lines(docs, rules, False)
        .groupBy("leaf", "doc_id", "content")
        .agg(F.max("weight").alias("weight"))
        .groupBy("leaf")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("weight").alias("weight"))
        .where((F.col("n_docs") >= rules.min_docs) & (F.col("n_docs") * F.col("weight") >= rules.min_mass))
        .select("leaf")
    )
    lines = _lines_of(spark, docs, rules, stored(spark, leaves, "leaves")).drop("weight")
    candidates = stored(spark, lines, "lines")
    forms = candidates.select("leaf", "form", "doc_id", "content").distinct().groupBy("leaf", "form").count()
    forms = forms.select("leaf", "form", F.col("count").alias("docs"))
    forms = stored(spark, forms.withColumn("form_no", F.monotonically_increasing_id()), "forms")
    # Exploded tokens carry the number of their form, and a hash that tells places and tokens of a leaf apart.
    places = forms.select("leaf", "form_no", "docs", F.posexplode(F.split("form", " ")).alias("place", "token"))
    # The leading tokens are the path; places behind them are constant where documents agree, and vary elsewhere.
    behind = places.where((F.col("place") >= rules.depth) & (F.col("token") != FIELD)).select(
        "leaf", "form_no", "place", "docs", F.xxhash64("place", "token").alias("key")
    )
    rare = (
        behind.groupBy("leaf", "key")
        .agg(F.sum("docs").alias("n"), F.min(F.struct("form_no", "place")).alias("one"))
        .where(F.col("n") < rules.min_docs)
    )
    if rules.min_docs <= 2:
        varying = rare.select("one.*")  # a token of one document has one place
    else:
        rare = stored(spark, rare.select("leaf", "key"), "rare")
        varying = behind.join(rare, ["leaf", "key"], "left_semi").select("form_no", "place")
    varying = varying.groupBy("form_no").agg(F.collect_set("place").alias("varying"))
    tokens = F.transform(
        F.split("form", " "),
        lambda token, place: F.when(F.array_contains("varying", place), FIELD).otherwise(token),
    )
    general = forms.join(stored(spark, varying, "varying"), "form_no", "left").select(
        "leaf",
        "form",
        F.coalesce(F.size("varying"), F.lit(0)).alias("n_varying"),
        F.when(F.col("varying").isNull(), F.split("form", " ")).otherwise(tokens).alias("template"),
    )
    kept = F.filter("template", lambda token: token != FIELD)
    heavy = F.aggregate(
        kept, F.lit(0), lambda sum_, token: sum_ + F.greatest(F.lit(1), F.floor(F.length(token) / rules.token_chars).cast("int"))
    )
    general = (
        general.withColumn("n_constant", F.size(kept))
        .where(F.col("n_constant") >= (F.col("n_constant") + F.col("n_varying")) * rules.min_constant)
        .select("leaf", "form", F.array_join("template", " ").alias("template"), heavy.alias("weight"))
        .where(F.col("weight") >= rules.min_constant_weight)
    )
    parsed = candidates.join(stored(spark, general, "general"), ["leaf", "form"]).drop("form", "leaf")
    parsed = stored(spark, parsed, "parsed")
    place = F.struct("doc_id", "content", "line_no")
    recurring = (
        parsed.groupBy("template", "doc_id", "content")
        .agg(F.min("line_no").alias("line_no"), F.max("weight").alias("weight"))
        .groupBy("template")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("weight").alias("weight"), F.min(place).alias("keeper"))
        .where((F.col("n_docs") >= rules.min_docs) & (F.col("n_docs") * F.col("weight") >= rules.min_mass))
    )
    recurring = stored(spark, recurring.select("template", "keeper"), "recurring")
    recurring = small_side(recurring, F.octet_length("template") + 128)
    return parsed.drop("weight").join(recurring, "template").select(
        "doc_id", "content", "line_no", "template", place.eqNullSafe(F.col("keeper")).alias("first")
    )


def drop_recurring_lines(
    spark: SparkSession, docs: DataFrame, rules: Rules = Rules(), column: str = "dedup"
) -> DataFrame:
    """``docs`` with the struct ``column``: ``text`` without the dropped lines, their number and ``kept``.

    The first line of a recurring template, by doc_id (nulls first), text digest and place, stays where it
    is, so copies of a document lose their lines and the first of them does not. ``kept`` is false only for
    a document that is left with nothing but white space. Null texts stay null, and texts that lose no
    line stay as they are, empty ones too; all these are kept. Rows that repeat an id and its text count as one document and get the same lines
    dropped. Columns of ``docs`` stay as they are; ``column`` must not be among them.
    """
    found = recurring_lines(spark, docs.select("doc_id", "text"), rules).where(~F.col("first"))
    gone = found.groupBy("doc_id", "content").agg(F.collect_set("line_no").alias("gone"))
    gone = small_side(stored(spark, gone, "gone"), 128 + 4 * F.size("gone"))
    gone = gone.select(F.struct("doc_id", "content", "gone").alias(column))
    of = lambda name: F.col(f"{column}.{name}")
    # A document without an id or a text joins by null-safe equality.
    same = docs["doc_id"].eqNullSafe(of("doc_id")) & (F.md5(docs["text"]) == of("content"))
    joined = docs.join(gone, same, "left")
    # Lines and what is left of them are columns, as an expression inside a lambda runs once an element.
    name, rest = _free(joined, "lines"), _free(joined, "rest")
    joined = joined.withColumn(name, F.split(docs["text"], "\n"))
    places = F.array_except(F.sequence(F.lit(0), F.size(name) - 1), of("gone"))
    left = F.array_join(F.transform(places, lambda i: F.get(F.col(name), i)), "\n")
    joined = joined.withColumn(rest, F.when(F.col(column).isNotNull(), left))
    return joined.select(
        *[docs[name] for name in docs.columns],
        F.struct(
            F.when(F.col(column).isNull(), docs["text"]).otherwise(F.col(rest)).alias("text"),
            F.coalesce(F.size(name), F.lit(0)).alias("n_lines"),
            F.coalesce(F.size(of("gone")), F.lit(0)).alias("n_dropped"),
            (F.col(column).isNull() | F.col(rest).rlike(f"[^{SPACE}]")).alias("kept"),
        ).alias(column),
    )


def _free(df: DataFrame, name: str) -> str:
    """``name``, lengthened until it is none of the columns."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def line_report(spark: SparkSession, docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """What ``drop_recurring_lines`` does to each document, with the digest of the text it leaves."""
    found = drop_recurring_lines(spark, docs.select("doc_id", "text"), rules)
    return found.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.col("dedup.n_lines")).cast("long").alias("n_lines"),
        F.greatest("dedup.n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.col("dedup.kept").alias("kept"),
        F.sha2("dedup.text", 256).alias("text_sha256"),
    )


def sql(rules: Rules = Rules()) -> str:
    """The same report for DuckDB."""
    return rf"""
WITH docs AS (SELECT DISTINCT doc_id, text, md5(text) AS content FROM documents WHERE text IS NOT NULL),
split_lines AS (
  SELECT doc_id, content, generate_subscripts(parts, 1) - 1 AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, content, string_split(text, chr(10)) AS parts FROM docs)),
lines AS (SELECT doc_id, content, line_no, regexp_extract_all(line, '[^{SPACE}]+') AS words FROM split_lines),
leafed AS (
  SELECT doc_id, content, line_no, tokens, len(tokens) || ' ' || array_to_string(tokens[1:{rules.depth}], ' ') AS leaf
  FROM (SELECT *, [CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END for x in words] AS tokens FROM lines)
  WHERE list_sum([greatest(1, length(x) // {rules.token_chars}) for x in words]) >= {rules.min_weight}),
forms AS (
  SELECT leaf, tokens, count(*) AS docs
  FROM (SELECT DISTINCT leaf, tokens, doc_id, content FROM leafed) GROUP BY leaf, tokens),
places AS (
  SELECT leaf, tokens, docs, generate_subscripts(tokens, 1) - 1 AS place, unnest(tokens) AS token FROM forms),
constant AS (
  SELECT leaf, place, token FROM places WHERE place >= {rules.depth}
  GROUP BY ALL HAVING sum(docs) >= {rules.min_docs}),
general AS (
  SELECT p.leaf, p.tokens, list(CASE WHEN p.place < {rules.depth} OR c.token IS NOT NULL THEN p.token ELSE '{FIELD}' END
    ORDER BY p.place) AS template
  FROM places p LEFT JOIN constant c ON p.leaf = c.leaf AND p.place = c.place AND p.token = c.token
  GROUP BY p.leaf, p.tokens),
weighed AS (
  SELECT *, list_sum([greatest(1, length(x) // {rules.token_chars}) for x in template if x <> '{FIELD}']) AS weight,
    len([x for x in template if x <> '{FIELD}']) AS n_constant, len([x for x in tokens if x <> '{FIELD}']) AS n_words
  FROM general),
parsed AS (
  SELECT c.doc_id, c.content, c.line_no, g.weight, array_to_string(g.template, ' ') AS template
  FROM leafed c JOIN weighed g ON c.leaf = g.leaf AND c.tokens = g.tokens
  WHERE g.weight >= {rules.min_constant_weight} AND g.n_constant >= g.n_words * {rules.min_constant}),
recurring AS (
  SELECT template FROM (SELECT template, doc_id, content, max(weight) AS weight FROM parsed GROUP BY ALL)
  GROUP BY template HAVING count(*) >= {rules.min_docs} AND count(*) * max(weight) >= {rules.min_mass}),
ranked AS (
  SELECT doc_id, content, line_no,
    row_number() OVER (PARTITION BY template ORDER BY doc_id NULLS FIRST, content, line_no) AS nth
  FROM parsed WHERE template IN (SELECT template FROM recurring)),
gone AS (SELECT DISTINCT doc_id, content, line_no FROM ranked WHERE nth > 1),
rest AS (
  SELECT l.doc_id, l.content, count(*) AS n_lines, count(g.line_no) AS n_dropped,
    string_agg(CASE WHEN g.line_no IS NULL THEN l.line END, chr(10) ORDER BY l.line_no) AS text
  FROM split_lines l LEFT JOIN gone g
    ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.content = g.content AND l.line_no = g.line_no
  GROUP BY l.doc_id, l.content)
SELECT d.doc_id, coalesce(r.n_lines, 0)::BIGINT AS n_lines, coalesce(r.n_dropped, 0)::BIGINT AS n_dropped,
  coalesce(r.n_dropped = 0 OR regexp_matches(coalesce(r.text, ''), '[^{SPACE}]'), true) AS kept,
  CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(r.text, '')) END AS text_sha256
FROM documents d LEFT JOIN rest r ON d.doc_id IS NOT DISTINCT FROM r.doc_id AND md5(d.text) = r.content
"""
