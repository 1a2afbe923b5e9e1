"""How the words of each source differ from the other sources of its language.

Identical texts of a language are collapsed first: each is taken once, with the number of its rows in
every source, and tokenized once. Its term counts and document counts enter the sums weighted by these
numbers. Sources are then compared over sparse counts: a term that a source lacks has one and the same
probability there, so a pair of sources is the value for terms that both lack, times all terms, corrected
for the terms that either has and for those that both have.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake.llm import arrow
from paylake.llm.ordering import stored

# Terms are runs of ASCII letters and characters above ASCII; only A-Z are lower-cased.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
# Counts that a task holds before it hands them on.
HELD = 400_000


@dataclass(frozen=True)
class Rules:
    min_docs: int = 3  # documents of a language that hold a term worth keeping
    scale: int = 1_000_000_000  # probabilities are whole numbers, one over this scale
    top: int = 200  # terms listed for each source


TERMS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")])


def collapsed(docs: DataFrame) -> DataFrame:
    """Each distinct text of a language once (lang, text), with ``sources``: how many rows of each source hold it.

    Copies are counted and dropped before their shuffles, so a text that a third of all rows share
    arrives once a task. ``sources`` has one entry for each source of the language at most.
    """
    rows = _rows(docs).withColumn("content", F.sha2("text", 256))
    copies = (
        rows.groupBy("lang", "content", "source")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang", "content")
        .agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    )
    texts = rows.select("lang", "content", "text").dropDuplicates(["lang", "content"])
    return texts.join(copies, ["lang", "content"]).select("lang", "text", "sources")


def _count(batches):
    """Partial sums of (lang, source, term): occurrences and documents, weighted by the copies of a text."""
    counts: dict[tuple[str, str], Counter] = {}
    holders: dict[tuple[str, str], Counter] = {}

    def hand_on():
        for (lang, source), terms in counts.items():
            names = list(terms)
            yield arrow.table(
                TERMS,
                lang=pa.array([lang]).take(pa.array([0] * len(names))),
                source=pa.array([source]).take(pa.array([0] * len(names))),
                term=pa.array(names, pa.binary()).cast(pa.string()),
                n=pa.array(list(terms.values()), pa.int64()),
                docs=pa.array([holders[lang, source][name] for name in names], pa.int64()),
            )
        counts.clear(), holders.clear()

    for batch in arrow.text_slices(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        langs, sources = batch.column("lang").to_pylist(), batch.column("sources").to_pylist()
        for lang, text, copies in zip(langs, texts, sources, strict=True):
            words = text.translate(TERM_BYTES).split()
            if not words:
                continue
            once = None
            for entry in copies:
                group, n = (lang, entry["source"]), entry["n"]
                total, held = counts.setdefault(group, Counter()), holders.setdefault(group, Counter())
                if n == 1 and len(copies) == 1:
                    total.update(words)
                    held.update(set(words))
                    continue
                once = once or Counter(words)
                for term, times in once.items():
                    total[term] += n * times
                    held[term] += n
        if sum(map(len, counts.values())) > HELD:
            yield from hand_on()
    yield from hand_on()


def term_counts(docs: DataFrame) -> DataFrame:
    """``n`` occurrences and ``docs`` documents of every (lang, source, term) that occurs."""
    partial = arrow.map_batches(collapsed(docs), _count, TERMS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _probability(n: Column | str, total: str, rules: Rules) -> Column:
    """1 + floor(scale * (n + 1) / (total + vocabulary)), null without a vocabulary."""
    over = F.lit(rules.scale).cast("decimal(10,0)") * (F.lit(n) + 1 if isinstance(n, int) else F.col(n) + 1).cast("decimal(19,0)")
    under = F.nullif(F.col(total) + F.col("vocabulary"), F.lit(0)).cast("decimal(19,0)")
    return F.call_function("div", over, under) + 1


def _off(p: Column | str, q: Column | str) -> Column:
    """floor((p - q)^2 / q); whole numbers of at most the scale, so it fits a long."""
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


def _pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``value`` of every two sources of a language, from the terms that they have."""
    # Probabilities depend on the count alone, so terms of equal counts go together.
    equal = entries.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("q0"), "vocabulary")
    own = groups.select("lang", "source", F.col("absent").alias("p0"))
    sides = own.join(others, "lang").where("source != item")
    both_lack = _off("p0", "q0")
    base = sides.select(
        "lang", "source", "item", F.coalesce(F.col("vocabulary") * both_lack, F.lit(0)).alias("value")
    )
    first_has = (
        equal.join(sides, ["lang", "source"])
        .select("lang", "source", "item", (F.col("terms") * (_off("p", "q0") - both_lack)).alias("value"))
    )
    second = equal.select("lang", F.col("source").alias("item"), F.col("p").alias("q"), "terms")
    second_has = (
        second.join(sides, ["lang", "item"])
        .select("lang", "source", "item", (F.col("terms") * (_off("p0", "q") - both_lack)).alias("value"))
    )
    # Terms of both, each pair of sources once and in both directions.
    a = entries.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("absent").alias("a0"))
    b = entries.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("absent").alias("b0"))

    def beyond(p: str, p0: str, q: str, q0: str) -> Column:
        return _off(p, q) - _off(p, q0) - _off(p0, q) + _off(p0, q0)

    both = (
        a.join(b, ["lang", "term"])
        .where("a < b")
        .groupBy("lang", "a", "b")
        .agg(F.sum(beyond("pa", "a0", "pb", "b0")).alias("ab"), F.sum(beyond("pb", "b0", "pa", "a0")).alias("ba"))
    )
    both = both.select(
        "lang",
        F.inline(
            F.array(
                F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("ab").alias("value")),
                F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("ba").alias("value")),
            )
        ),
    )
    summed = base.union(first_has).union(second_has).union(both)
    return summed.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def divergence(spark: SparkSession, docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Divergence of each source from the others of its language, and its terms above the language's share.

    Rows are (lang, source, part, item, value, rank). In part ``pair`` items are the other sources; a
    source alone in its language has none, and values are 0 where a language keeps no term. In part
    ``term`` items are the ``top`` terms that stand out. Ranks fall with the value, ties go by the
    item's bytes. Null text, language and source are empty strings, a source without any term is
    still compared, repeated rows count each, an empty table gives no rows, and other columns are
    not read. All numbers are whole, so they do not depend on the order of tasks.
    """
    counts = stored(spark, term_counts(docs), "terms")
    kept = (
        counts.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= rules.min_docs)
        .select("lang", "term", "lang_n")
    )
    kept = stored(spark, kept, "kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"), F.sum("lang_n").alias("lang_total"))
    entries = stored(spark, counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "entries")
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        _rows(docs)
        .select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "vocabulary", "lang_total"])
        .withColumn("absent", _probability(0, "total", rules))
    )
    groups = stored(spark, groups, "groups")
    told = entries.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        "absent",
        _probability("n", "total", rules).alias("p"),
        _probability("lang_n", "lang_total", rules).alias("q"),
    )
    told = stored(spark, told, "shares")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(told, groups).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank")
    )
    terms = told.where("p > q").select("lang", "source", F.col("term").alias("item"), _off("p", "q").alias("value"))
    terms = (
        terms.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= rules.top)
        .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    )
    return pairs.union(terms)


def sql(rules: Rules = Rules()) -> str:
    """The same rows for DuckDB, with every term of every pair written out."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT lang, source, doc, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS doc FROM docs)),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= {rules.min_docs}),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term
  GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM groups g
  LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
shares AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({rules.scale}::HUGEINT * (coalesce(c.n, 0) + 1)) // (t.total + s.v) AS p,
    1 + ({rules.scale}::HUGEINT * (k.n + 1)) // (s.total + s.v) AS q
  FROM totals t JOIN sizes s ON t.lang = s.lang JOIN kept k ON t.lang = k.lang
  LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value
  FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= {rules.top}
"""
