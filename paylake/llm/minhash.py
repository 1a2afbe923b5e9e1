"""MinHash near-duplicates by min-max hashing, banded, with links confirmed on full shingle sets.

Every permutation of the shingles' hashes gives two values, its minimum and its maximum, so a
signature takes half as many hash evaluations as it has values. Each agrees between two texts with a
probability equal to their Jaccard similarity. A band joins values of one kind from several
permutations; texts that agree in a band share a bucket.

A bucket is never expanded into its pairs. First all of it is compared with one hub, the text that
shares most buckets with others: what is like the hub is connected through it. Where a bucket then
still holds texts that are connected to different ones, those apart from the hub are compared, block by
block, with all of the bucket, leaving out what is connected by then. So every two texts of a
bucket are compared or already in one component.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import arrow
from paylake.llm.components import components
from paylake.llm.ordering import stored

SEED = 20260611
# Shingles that one block of a bucket holds, or those of one longer text.
BLOCK = 50_000


@dataclass(frozen=True)
class Rules:
    """Two texts at ``percent`` similarity share no bucket once in 2 million times (6 rows, 48 bands)."""

    words: int = 2  # words of a shingle
    percent: int = 80  # least similarity of linked texts
    rows: int = 6  # signature values of a band
    bands: int = 48  # half of them of minima, half of maxima


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(strings: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text, A-Z lower-cased.

    A text of fewer words is one shingle, a text without words has none. Different shingles of two
    texts of a million words share a hash with a probability below 10^-7.
    """
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    coded = []
    for text in strings.cast(pa.binary()).to_pylist():
        split = text.lower().split()
        coded.append(np.fromiter(map(numbers.__getitem__, split), np.int64, len(split)))
    digest = xxhash.xxh64_intdigest
    value = np.fromiter((digest(word, SEED) for word in numbers), np.uint64, len(numbers))
    sets = []
    for codes in coded:
        if not len(codes):
            sets.append(np.zeros(0, np.uint64))
            continue
        size = min(words, len(codes))
        hashes = value[codes]
        rolled = np.full(len(codes) - size + 1, size, np.uint64)
        for step in range(size):
            rolled = _mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[step : step + len(rolled)])
        sets.append(np.unique(rolled))
    return sets


def band_keys(sets: list[np.ndarray], rules: Rules) -> np.ndarray:
    """One row of bucket keys for each non-empty set: bands of minima, then bands of maxima."""
    permutations = rules.rows * rules.bands // 2
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 1 << 31, permutations, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 1 << 32, permutations, dtype=np.uint32)
    begin = np.cumsum([0, *(len(s) for s in sets[:-1])])
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    values = np.empty((2, len(sets), permutations), np.uint32)
    for i in range(permutations):
        permuted = flat * odd[i] + shift[i]
        values[0, :, i] = np.minimum.reduceat(permuted, begin)
        values[1, :, i] = np.maximum.reduceat(permuted, begin)
    bands = values.reshape(2, len(sets), rules.bands // 2, rules.rows).transpose(1, 0, 2, 3)
    bands = bands.reshape(len(sets), rules.bands, rules.rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(rules.bands, dtype=np.uint64), bands.shape[:2]).copy()
    for row in range(rules.rows):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, row])
    return keys


SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("content", pa.string()),
        ("n_shingles", pa.int64()),
        ("set_id", pa.string()),
        ("keys", pa.list_(pa.int64())),
    ]
)


def _content() -> Column:
    return F.md5(F.coalesce("text", F.lit("")))


def signatures(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``doc_id``, digest of the text, size and digest of its shingle set, and its bucket keys (null for an empty set)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(arrow.texts(batch), rules.words)
        full = [i for i, s in enumerate(sets) if len(s)]
        keys = [None] * len(sets)
        if full:
            for i, row in zip(full, band_keys([sets[i] for i in full], rules).view(np.int64), strict=True):
                keys[i] = row
        return arrow.table(
            SIGNED,
            doc_id=batch.column("doc_id"),
            content=batch.column("content"),
            n_shingles=[len(s) for s in sets],
            set_id=[xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets],
            keys=keys,
        )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _content().alias("content"))
    return arrow.map_slices(source, run, SIGNED)


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class _Trees(dict):
    """Union-find over the classes of one cell."""

    def find(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = self.get(up, up)
            x = up
        return x


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 times the intersection's size is at least ``percent`` times the union's."""
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(cells: DataFrame, texts: DataFrame, rules: Rules) -> DataFrame:
    """Links ``a, b`` that connect what a cell compares, as a spanning forest.

    ``cells`` are (cell, other, class, root): the rows of a cell with ``other`` = 0 are compared with
    those with 1, unless they have one root. Where a class is on both sides a pair is compared once.
    A task reads its cells in order and holds the first side of one cell.
    """

    def run(batches):
        cell, first, trees = None, [], _Trees()
        for batch in arrow.text_slices(batches):
            a, b = [], []
            sets = shingle_sets(arrow.texts(batch), rules.words)
            columns = [batch.column(name).to_pylist() for name in ("cell", "other", "class", "root", "both_sides")]
            for own, at, other, number, root, both_sides in zip(sets, *columns, strict=True):
                if at != cell:
                    cell, first, trees = at, [], _Trees()
                trees.setdefault(number, root)
                if not other:
                    first.append((number, both_sides, own))
                    continue
                for against, twice, theirs in first:
                    if against == number or (twice and both_sides and against > number):
                        continue
                    mine, yours = trees.find(number), trees.find(against)
                    if mine != yours and _alike(own, theirs, rules.percent):
                        trees[mine] = yours
                        a.append(against)
                        b.append(number)
            yield arrow.table(LINKS, a=a, b=b)

    placed = cells.join(texts, "class").repartition("cell").sortWithinPartitions("cell", "other")
    return arrow.map_batches(placed.select("cell", "other", "class", "root", "both_sides", "text"), run, LINKS)



def _fits(a: str, b: str, rules: Rules) -> Column:
    """Sets of these sizes can be alike."""
    return 100 * F.least(a, b) >= rules.percent * F.greatest(a, b)


def _hub_cells(spark: SparkSession, members: DataFrame, hubs: DataFrame, rules: Rules) -> DataFrame:
    """Cells that compare each hub with the texts it shares a bucket with, each pair once."""
    pairs = (
        members.join(hubs, "key")
        .where((F.col("class") != F.col("hub")) & _fits("n", "hub_n", rules))
        .select("hub", "class", "n")
        .distinct()
    )
    pairs = stored(spark, pairs, "pairs")
    # A hub with very many texts is dealt over several cells.
    blocks = stored(spark, pairs.groupBy("hub").agg(_ceiling(F.sum("n")).alias("blocks")), "hubs")
    dealt = pairs.join(blocks, "hub").select(
        "hub", "class", F.pmod(F.xxhash64("class"), F.col("blocks")).alias("block")
    )
    dealt = stored(spark, dealt, "dealt")
    cell = F.xxhash64("hub", "block").alias("cell")
    sides = [
        dealt.select(cell, F.lit(0).alias("other"), F.col("hub").alias("class")).distinct(),
        dealt.select(cell, F.lit(1).alias("other"), "class"),
    ]
    return sides[0].union(sides[1]).select("*", F.col("class").alias("root"), F.lit(False).alias("both_sides"))


def _ceiling(total: Column) -> Column:
    return F.greatest(F.ceil(total / BLOCK), F.lit(1)).cast("long")


def _rest_cells(spark: SparkSession, left: DataFrame) -> DataFrame:
    """Cells that compare, in each bucket, the texts apart from its hub with all others.

    ``left`` is (key, class, n, root, apart). Both sides are dealt into blocks, and each two blocks
    are one cell.
    """
    sizes = left.groupBy("key").agg(
        _ceiling(F.sum(F.when(F.col("apart"), F.col("n")).otherwise(0))).alias("rows"),
        _ceiling(F.sum("n")).alias("columns"),
    )
    dealt = left.join(stored(spark, sizes, "sizes"), "key")
    lane = lambda blocks: F.pmod(F.xxhash64("class"), F.col(blocks))
    each = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    first = dealt.where("apart").withColumn("row", lane("rows")).withColumn("column", each("columns"))
    second = dealt.withColumn("column", lane("columns")).withColumn("row", each("rows"))
    cell = F.xxhash64("key", "row", "column").alias("cell")
    kept = ["class", "root", F.col("apart").alias("both_sides")]
    return first.select(cell, F.lit(0).alias("other"), *kept).union(second.select(cell, F.lit(1).alias("other"), *kept))


def _roots(spark: SparkSession, classes: DataFrame, docs: DataFrame, rules: Rules) -> DataFrame:
    """``node, root`` of the classes that are connected to others, through all that are alike and share a bucket."""
    buckets = classes.select("class", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(spark, buckets.join(stored(spark, shared, "shared"), "key"), "members")
    # Written before their joins: a class or a key of many rows is split by AQE.
    weights = stored(spark, members.groupBy("class").agg(F.sum("size").alias("weight")), "weights")
    members = members.join(weights, "class").select("key", "class", "n", "weight")
    members = stored(spark, members, "weighed")
    best = F.max(F.struct("weight", -F.col("class"), "class", "n")).alias("best")
    hubs = members.groupBy("key").agg(best).select(
        "key", F.col("best.class").alias("hub"), F.col("best.n").alias("hub_n")
    )
    hubs = stored(spark, hubs, "bucket-hubs")
    texts = _texts(spark, classes.join(weights.select("class"), "class", "left_semi"), docs)
    found = stored(spark, confirmed(_hub_cells(spark, members, hubs, rules), texts, rules), "confirmed")
    roots = stored(spark, components(spark, found), "roots")
    root = F.coalesce("root", "class").alias("root")
    named = members.join(roots.withColumnRenamed("node", "class"), "class", "left").select("key", "class", "n", root)
    hub_roots = hubs.join(roots.withColumnRenamed("node", "hub"), "hub", "left").select(
        "key", "hub", F.coalesce("root", "hub").alias("hub_root")
    )
    hub_roots = stored(spark, hub_roots, "hub-roots")
    # The hub itself has been compared with all of its bucket.
    left = named.join(hub_roots, "key").where("class != hub").withColumn("apart", F.col("root") != F.col("hub_root"))
    left = stored(spark, left.select("key", "class", "n", "root", "apart"), "left")
    mixed = left.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    left = stored(spark, left.join(stored(spark, mixed.select("key"), "mixed"), "key"), "unsettled")
    rest = stored(spark, confirmed(_rest_cells(spark, left), texts, rules), "confirmed")
    if rest.isEmpty():
        return roots
    return components(spark, rest.union(roots.where("node != root").select("root", "node")))


def _texts(spark: SparkSession, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``class, text`` of the given classes; one text of each stands for all with that set."""
    wanted = stored(spark, classes.select("class", F.col("sample.doc_id").alias("id"), F.col("sample.content").alias("content")), "wanted")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    same = source["doc_id"].eqNullSafe(wanted["id"]) & (F.md5(source["text"]) == wanted["content"])
    texts = source.join(wanted, same).select("class", "text").dropDuplicates(["class"])
    return stored(spark, texts, "texts")


def near_duplicates(spark: SparkSession, docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    Documents whose shingle sets have a similarity of at least ``percent`` are linked; the component is the
    smallest non-null ``doc_id`` reachable, the document itself included (null if there is none).
    ``kept`` is true where that is the document's own id, so never without an id, and for each of the rows
    that repeat one. Null, empty and blank texts have an empty set and are linked with nothing,
    one another included. Equal sets are one class and enter the search once. Repeated rows stay repeated,
    an empty table gives no rows, other columns are not read.
    """
    rows = stored(spark, signatures(docs, rules), "signatures")
    some = rows.where("n_shingles > 0")
    sample = F.min(F.struct("doc_id", "content")).alias("sample")
    classes = some.groupBy("set_id").agg(
        F.min("doc_id").alias("first_id"), sample, F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")
    )
    classes = stored(spark, classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    roots = _roots(spark, classes, docs, rules)
    rooted = classes.join(roots, F.col("class") == F.col("node"), "left").select(
        "set_id", "first_id", F.coalesce("root", "class").alias("root")
    )
    rooted = stored(spark, rooted, "rooted")
    least = stored(spark, rooted.groupBy("root").agg(F.min("first_id").alias("component")), "least")
    named = stored(spark, rooted.join(least, "root").select("set_id", "component"), "named")
    linked = some.select("doc_id", "n_shingles", "set_id").join(named, "set_id").select("doc_id", "n_shingles", "component")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    return linked.union(alone).select(
        "doc_id",
        "n_shingles",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def sql(rules: Rules = Rules()) -> str:
    """The same rows for DuckDB, by comparing every two texts that share a shingle."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    last = " || ' ' || ".join(f"words[i + {step}]" for step in range(rules.words))
    return rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
shingled AS (
  SELECT row_no, doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < {rules.words} THEN [array_to_string(words, ' ')]
    ELSE [{last} for i in range(1, len(words) - {rules.words} + 2)] END) AS shingles FROM docs),
sets AS (
  SELECT min(row_no) AS class, min(doc_id) AS first_id, list_sort(shingles) AS shingles, list(row_no) AS rows
  FROM shingled WHERE len(shingles) > 0 GROUP BY list_sort(shingles)),
items AS (SELECT class, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.class AS a, b.class AS b FROM items a JOIN items b ON a.shingle = b.shingle AND a.class <> b.class
  WHERE 100 * least(a.n, b.n) >= {rules.percent} * greatest(a.n, b.n)
  GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= {rules.percent} * (a.n + b.n - count(*))),
reached AS (
  SELECT class, class AS other FROM sets
  UNION SELECT r.class, l.b FROM reached r JOIN links l ON r.other = l.a),
components AS (
  SELECT r.class, min(s.first_id) AS component FROM reached r JOIN sets s ON r.other = s.class GROUP BY r.class),
named AS (SELECT unnest(s.rows) AS row_no, c.component FROM sets s JOIN components c ON s.class = c.class)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles,
  CASE WHEN len(s.shingles) = 0 THEN s.doc_id ELSE n.component END AS component_id,
  coalesce(s.doc_id = CASE WHEN len(s.shingles) = 0 THEN s.doc_id ELSE n.component END, false) AS kept
FROM shingled s LEFT JOIN named n ON s.row_no = n.row_no
"""
