"""Secret scans over a content-addressed ledger, in DataFrame functions only.

Every historical version of a path is known by the SHA-256 of its text. A blob is
scanned once for each rule version, findings go to the ledger, and a scan of more versions only reads
blobs that the ledger does not hold yet. Findings are joined back to all paths with that content.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake.llm.ordering import stored


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if ``group`` of it has at least ``least`` characters."""

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0
    base: bool = True


# The three base kinds in their order.
ASSIGN = Rule(
    "assign", 1,
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2,
)
ACCESS = Rule("access", 1, r"AKIA[A-Z0-9]+", 20)
HEX = Rule("hex", 1, r"[0-9a-f]+", 24)
BASE_RULES = (ASSIGN, ACCESS, HEX)
# Added by the method: private key blocks and bearer headers.
EXTRA_RULES = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, base=False),
    Rule("bearer", 1, r"(?i:bearer)\x20+([A-Za-z0-9+/_.=-]+)", 16, 1, base=False),
)
RULES = (*BASE_RULES, *EXTRA_RULES)


SPAN = "struct<kind:string,start:bigint,end:bigint>"


def blob_id(text: Column) -> Column:
    """Content address; a null text is the empty blob."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def empty_ledger(spark: SparkSession) -> DataFrame:
    kinds = {"blob": "string", "scanned": "array<string>", "spans": f"array<{SPAN}>"}
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()])


def _key(rule: Rule) -> str:
    return f"{rule.kind}:{rule.version}"


def _pattern(rule: Rule) -> str:
    """For a whole match of one character class, its least length goes into the pattern.

    That skips the many short runs and finds the same long ones, as runs are maximal.
    """
    if rule.group == 0 and rule.pattern.endswith("]+"):
        fixed = rule.pattern.index("[")
        return f"{rule.pattern[:-1]}{{{rule.least - fixed},}}"
    return rule.pattern


def _parts(rule: Rule, number: int) -> Column:
    """Matches of a rule as (rule, nth, characters before since the last one, length, length of its value).

    ``split`` gives the text between matches and ``regexp_extract_all`` the matches, both leftmost
    and non-overlapping. The last part has no match.
    """
    text, pattern = F.col("text"), _pattern(rule)
    zipped = F.arrays_zip(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)),
    )
    parts = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(number).alias("rule"),
            i.alias("nth"),
            F.length(x["0"]).alias("gap"),
            F.length(x["1"]).alias("size"),
            F.length(x["2"]).alias("value"),
        ),
    )
    asked = F.array_contains("missing", _key(rule))
    kind = "array<struct<rule:int,nth:int,gap:int,size:int,value:int>>"
    return F.when(asked & text.rlike(pattern), parts).otherwise(F.array()).cast(kind)


def scan_unseen(
    spark: SparkSession, versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """New ledger entries for the texts of ``versions`` (path, text).

    Only blobs for which the ledger lacks a rule version are scanned, each once and for the
    lacking rules only. An entry names the rule versions scanned, and its spans (code points,
    end exclusive) by start; a blob without secrets gets an entry without spans.
    """
    known = ledger.groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("done"))
    wanted = F.array(*[F.lit(_key(rule)) for rule in rules])
    none = F.array().cast("array<string>")
    # Copies are combined before the shuffle, then the ledger is asked about each blob once.
    blobs = versions.select(
        blob_id(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text")
    ).dropDuplicates(["blob"])
    unseen = (
        blobs.join(known, "blob", "left")
        .withColumn("missing", F.array_except(wanted, F.coalesce("done", none)))
        .where(F.size("missing") > 0)
    )
    parts = F.concat(*[_parts(rule, i) for i, rule in enumerate(rules)])
    scanned = stored(spark, unseen.select("blob", "missing", parts.alias("parts")), "scanned")
    # Running sums of lengths give the places; only blobs with a match get here.
    part = scanned.select("blob", F.explode("parts").alias("part")).select("blob", "part.*")
    so_far = Window.partitionBy("blob", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    size = F.coalesce("size", F.lit(0)).cast("long")
    placed = part.withColumn("end", F.sum(F.col("gap") + size).over(so_far))
    least = F.element_at(F.array(*[F.lit(rule.least) for rule in rules]), F.col("rule") + 1)
    kind = F.element_at(F.array(*[F.lit(rule.kind) for rule in rules]), F.col("rule") + 1)
    span = F.struct(kind.alias("kind"), (F.col("end") - size).alias("start"), F.col("end"))
    found = (
        placed.where(F.col("value") >= least)
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list(F.struct((F.col("end") - size).alias("start"), "rule", span.alias("span")))).alias("spans"))
    )
    return scanned.join(found, "blob", "left").select(
        "blob",
        F.col("missing").alias("scanned"),
        F.coalesce(F.col("spans.span"), F.array().cast(f"array<{SPAN}>")).alias("spans"),
    )


def findings(versions: DataFrame, ledger: DataFrame) -> DataFrame:
    """Spans of every version (path, blob, spans), joined back over content addresses.

    A ledger may hold several entries of a blob, one for each set of rules; spans of a kind
    that was scanned in more than one rule version are those of every version. Versions whose blob the
    ledger does not hold are left out.
    """
    known = stored(ledger.sparkSession, ledger.select("blob").distinct(), "known")
    paths = versions.select("path", blob_id(F.col("text")).alias("blob"))
    return _with_spans(paths.join(known, "blob", "left_semi"), ledger)


def _with_spans(paths: DataFrame, ledger: DataFrame) -> DataFrame:
    """Spans of each (path, blob); blobs without any have no row in the join and get an empty list.

    Spans are written first: a blob that very many paths share is split by AQE, which needs both
    sides of the join straight from a shuffle.
    """
    found = ledger.where(F.size("spans") > 0).groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    joined = paths.join(stored(ledger.sparkSession, found, "spans"), "blob", "left")
    return joined.withColumn("spans", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")))


def _digest(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, by start and then by the kinds' order."""
    order = [rule.kind for rule in RULES]
    ranked = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.array_position(F.array(*map(F.lit, order)), s["kind"]).alias("rank"),
                F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")).alias("name"),
            ),
        )
    )
    return F.array_join(F.transform(ranked, lambda s: s["name"]), ",")


def secret_report(spark: SparkSession, docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Base counts, the base spans' digest and all spans of every document.

    Null texts count as empty: no spans. Repeated rows are reported each. An empty table gives no rows.
    """
    versions = docs.select(F.col("doc_id").alias("path"), "text")
    ledger = empty_ledger(spark) if ledger is None else ledger
    new = stored(spark, scan_unseen(spark, versions, ledger), "ledger")
    # Every blob has been scanned by now.
    paths = versions.select("path", blob_id(F.col("text")).alias("blob"))
    found = _with_spans(paths, ledger.unionByName(new))
    kinds = [rule.kind for rule in BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(_digest(base), 256).alias("base_sha256"),
        _digest(F.col("spans")).alias("spans"),
    )


def sql() -> str:
    """The same report for DuckDB: lengths of matches and of the texts between them, added up."""

    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    parts = " UNION ALL ".join(
        f"""SELECT row_no, '{rule.kind}' AS kind, {i} AS rank, {rule.least} AS least,
            string_split_regex(text, {quoted(_pattern(rule))}) AS gaps,
            regexp_extract_all(text, {quoted(_pattern(rule))}) AS found,
            regexp_extract_all(text, {quoted(_pattern(rule))}, {rule.group}) AS value FROM docs"""
        for i, rule in enumerate(RULES)
    )
    base = ", ".join(f"'{rule.kind}'" for rule in BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE_RULES)
    zeros = ", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in BASE_RULES)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({parts}),
places AS (
  SELECT row_no, kind, rank, length(found[i]) AS size, length(value[i]) AS value_size, least,
    list_sum([length(g) for g in gaps[1:i]]) + coalesce(list_sum([length(m) for m in found[1 : i - 1]]), 0) AS start
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM parts)),
named AS (
  SELECT row_no, kind, rank, start, concat(kind, ':', CAST(start AS BIGINT), ':', CAST(start + size AS BIGINT)) AS name
  FROM places WHERE value_size >= least),
told AS (
  SELECT row_no, {counts},
    string_agg(name, ',' ORDER BY start, rank) FILTER (kind IN ({base})) AS base,
    string_agg(name, ',' ORDER BY start, rank) AS spans
  FROM named GROUP BY row_no)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (row_no)
"""
