"""SimHash near-duplicates: fingerprints linked by a self-join of binary tries.

Two fingerprints that differ in at most ``k`` bits differ in at most ``k // 2`` bits of their
upper or of their lower half. Two tries are joined with themselves, one over the bits as
they are and one with the halves exchanged. Both traverse pairs of nodes together, add up differing
bits and drop a pair as soon as its budget is exceeded: ``k // 2`` within the first half, ``k`` in all.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import arrow
from paylake.llm.components import components
from paylake.llm.ordering import stored
from paylake.llm.workers import ship

BITS = 64
SEED = 42
# A node of the tries' tops is split further while it holds more fingerprints than this.
NODE_SIZE = 65_536
DEEPEST = 24


def shingles(text: str, words: int) -> list[bytes]:
    """Word shingles of an ASCII-lower-cased text; a shorter text is one shingle, an empty one none."""
    split = text.encode().lower().split()
    if len(split) <= words:
        return [b" ".join(split)] if split else []
    return [b" ".join(split[i : i + words]) for i in range(len(split) - words + 1)]


# Shingles whose bits are counted at once, or those of one longer text.
SETTLE = 50_000


def fingerprints(strings: pa.Array, words: int) -> np.ndarray:
    """64-bit SimHash of each text: a bit is set if over half of its shingles' hashes have it."""
    hashes: list[int] = []
    sizes = []
    out = np.zeros(len(strings), np.uint64)
    digest = xxhash.xxh64_intdigest
    rows: list[int] = []

    def settle() -> None:
        if not rows:
            return
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int32)
        over = counts * 2 > np.array(sizes)[:, None]
        out[rows] = np.packbits(over, axis=1).view(">u8").ravel()
        hashes.clear(), sizes.clear(), rows.clear()

    for i, text in enumerate(strings.to_pylist()):
        parts = shingles(text, words)
        if parts:
            hashes.extend([digest(part, SEED) for part in parts])
            sizes.append(len(parts))
            rows.append(i)
        if len(hashes) > SETTLE:
            settle()
    settle()
    return out


def with_fingerprint(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, digest of the text and ``fp`` (the 64 bits as a signed long); null texts count as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("content", pa.string()), ("fp", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = fingerprints(arrow.texts(batch), words).view(np.int64)
        return arrow.table(
            schema, doc_id=batch.column("doc_id").cast(pa.int64()), content=batch.column("content"), fp=found
        )

    content = F.md5(F.coalesce("text", F.lit(""))).alias("content")
    return arrow.map_slices(docs.select("doc_id", "text", content), run, schema)


def _middle(keys: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> np.ndarray:
    """Where the 1-branch begins in each sorted stretch [low, high) below a node at ``depth``."""
    bit = np.uint64(BITS - 1 - depth)
    border = (keys[low] >> bit | np.uint64(1)) << bit
    return np.clip(np.searchsorted(keys, border), low, high)


class Forest:
    """Union-find over array places, with many links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: np.ndarray) -> np.ndarray:
        while True:
            up = self.root[i]
            if (up == i).all():
                return i
            self.root[i] = self.root[up]
            i = self.root[i]

    def link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Join pairs; returns which of them joined two trees (a spanning forest of all links)."""
        chosen = []
        places = np.arange(len(a))
        while len(places):
            ra, rb = self.find(a[places]), self.find(b[places])
            apart = ra != rb
            places, ra, rb = places[apart], ra[apart], rb[apart]
            if not len(places):
                break
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            tops, first = np.unique(high, return_index=True)
            self.root[tops] = low[first]
            chosen.append(places[first])
        return np.concatenate(chosen) if chosen else np.zeros(0, np.int64)


# Node pairs looked at together.
CHUNK = 1 << 16


def trie_links(
    keys: np.ndarray, starts: list[tuple[int, int, int, int, int, int]], limit: int
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of all links between pairs of trie nodes over sorted, distinct keys.

    A start is (first and end place of one node, first and end of the other, bits that differ
    above the depth, depth). Pairs go down level by level. A pair is dropped when its differing
    bits exceed the budget, or when all keys below both nodes are already in one tree.
    """
    half = limit // 2
    forest = Forest(len(keys))
    tree = run = None
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    fresh = 0
    stack = [(*(np.array([x], np.int64) for x in start[:4]), np.array([start[4]]), start[5]) for start in starts]
    while stack:
        a0, a1, b0, b1, diff, depth = stack.pop()
        if len(a0) > CHUNK:
            mid = len(a0) // 2
            stack.append((a0[mid:], a1[mid:], b0[mid:], b1[mid:], diff[mid:], depth))
            stack.append((a0[:mid], a1[:mid], b0[:mid], b1[:mid], diff[:mid], depth))
            continue
        keep = np.ones(len(a0), bool)
        if tree is not None:
            keep = (tree[a0] != tree[b0]) | (run[a1 - 1] != run[a0]) | (run[b1 - 1] != run[b0])
        leaf = keep & (a1 - a0 == 1) & (b1 - b0 == 1)
        i, j = a0[leaf], b0[leaf]
        near = (np.bitwise_count(keys[i] ^ keys[j]) <= limit) & (i != j)
        i, j = i[near], j[near]
        new = forest.link(i, j)
        out_a.append(i[new])
        out_b.append(j[new])
        fresh += len(new)
        if fresh > len(keys) // 20 + 100:
            tree = forest.find(np.arange(len(keys)))
            run = np.cumsum(np.diff(tree, prepend=tree[:1]) != 0)
            fresh = 0
        keep &= ~leaf
        a0, a1, b0, b1, diff = (x[keep] for x in (a0, a1, b0, b1, diff))
        if not len(a0):
            continue
        am, bm = _middle(keys, a0, a1, depth), _middle(keys, b0, b1, depth)
        budget = half if depth < BITS // 2 else limit
        own = (a0 == b0) & (a1 == b1)  # a node with itself: both mixed pairs are the same
        below = []
        for p0, p1, q0, q1, cost in (
            (a0, am, b0, bm, 0),
            (am, a1, bm, b1, 0),
            (a0, am, bm, b1, 1),
            (am, a1, b0, bm, 1),
        ):
            keep = (p1 > p0) & (q1 > q0) & (diff + cost <= budget)
            if p0 is am and q0 is b0:
                keep &= ~own
            below.append([x[keep] for x in (p0, p1, q0, q1, diff + cost)])
        below = [np.concatenate(x) for x in zip(*below, strict=True)]
        if len(below[0]):
            stack.append((*below, depth + 1))
    return np.concatenate(out_a), np.concatenate(out_b)


def _nodes(spark: SparkSession, keys: DataFrame, count: int) -> list[tuple[int, int]]:
    """Tops of the trie as (prefix, depth), each with at most about ``NODE_SIZE`` keys.

    Only counts per node reach the driver: one for every ``NODE_SIZE`` keys or so. Nodes end within the first
    half, whose budget tells which of them meet; a node of ``DEEPEST`` or more bits is not split any further,
    and holds the fingerprints that are equal in these bits.
    """
    depth = ((max(count, 1) - 1) // NODE_SIZE).bit_length()
    parents, done = None, []
    while parents is None or parents:
        at = keys.select(_prefix(depth).alias("prefix"))
        if parents is not None:
            above = spark.createDataFrame(pa.table({"parent": pa.array(parents, pa.int64())}))
            at = at.join(F.broadcast(above), F.shiftright("prefix", 4) == F.col("parent"), "left_semi")
        counts = at.groupBy("prefix").count().collect()
        parents = [r["prefix"] for r in counts if r["count"] > 4 * NODE_SIZE and depth < DEEPEST]
        inner = set(parents)
        done += [(r["prefix"], depth) for r in counts if r["prefix"] not in inner]
        depth += 4
    return done


def _prefix(depth: int):
    return F.shiftrightunsigned("key", BITS - depth) if depth else F.lit(0).cast("long")


def _meetings(spark: SparkSession, nodes: list[tuple[int, int]], least: int, half: int) -> DataFrame:
    """Which nodes come to which owner: each pair of nodes within the budget meets at one owner.

    Cells are the nodes' prefixes at the least depth. Cells within ``half`` flipped bits
    are found by flipping bits, so far nodes are never compared. The driver holds the nodes only.
    """
    masks = [sum(1 << b for b in bits) for k in range(half + 1) for bits in combinations(range(least), k)]
    table = np.array([(i, *node) for i, node in enumerate(nodes)], np.int64).reshape(-1, 3)
    rows = spark.createDataFrame(pa.table([pa.array(x) for x in table.T], names=["number", "prefix", "depth"]))
    up = lambda prefix, bits: F.expr(f"shiftright({prefix}, cast({bits} as int))")
    rows = rows.withColumn("cell", up("prefix", f"depth - {least}"))
    owners = rows.select(
        F.col("number").alias("owner"),
        F.col("prefix").alias("own_prefix"),
        F.col("depth").alias("own_depth"),
        F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: F.col("cell").bitwiseXOR(m))).alias("cell"),
    )
    met = owners.join(rows, "cell").where("owner <= number").withColumn("common", F.least("depth", "own_depth"))
    differ = up("prefix", "depth - common").bitwiseXOR(up("own_prefix", "own_depth - common"))
    met = met.withColumn("spent", F.bit_count(differ)).where(F.col("spent") <= half)
    mine = (F.col("owner") == F.col("number")).cast("long").alias("mine")
    return met.select("owner", "cell", "prefix", "depth", "spent", "common", mine)


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _walk(turned: bool, limit: int):
    """The trie walk over the keys that meet at one owner."""

    def walk(group: pa.Table) -> pa.Table:
        columns = {name: group.column(name).to_numpy() for name in group.column_names}
        order = np.argsort(columns["key"].view(np.uint64))
        columns = {name: values[order] for name, values in columns.items()}
        key = columns["key"].view(np.uint64)
        fresh = (np.diff(columns["prefix"]) != 0) | (np.diff(columns["depth"]) != 0)
        edges = np.concatenate([[0], np.flatnonzero(fresh) + 1, [len(key)]])
        stretches = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
        mine = next((x for x in stretches if columns["mine"][x[0]]), None)
        starts = [
            (*mine, *x, int(columns["spent"][x[0]]), int(columns["common"][x[0]])) for x in stretches if mine
        ]
        i, j = trie_links(key, starts, limit)
        fp = (key << np.uint64(32) | key >> np.uint64(32)) if turned else key
        return pa.table([pa.array(fp[i].view(np.int64)), pa.array(fp[j].view(np.int64))], schema=LINKS)

    return walk


def links(spark: SparkSession, distinct: DataFrame, limit: int) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints within ``limit`` bits, as spanning forests.

    The keys of a node and of each node within the budget meet in one task, where the
    trie walk joins them. A link inside what is already connected is left out; none that
    connects two parts is lost.
    """
    ship(spark)
    count = distinct.count()
    found = []
    for turned in (False, True):
        swap = F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
        keys = distinct.select((swap if turned else F.col("fp")).alias("key"))
        nodes = _nodes(spark, keys, count)
        least = min((depth for _, depth in nodes), default=0)
        meetings = stored(spark, _meetings(spark, nodes, least, limit // 2), "meetings")
        own = F.expr(f"if(depth = 0, 0L, shiftrightunsigned(key, cast({BITS} - depth as int)))")
        met = keys.withColumn("cell", _prefix(least)).join(meetings, "cell").where(own == F.col("prefix"))

        found.append(met.groupBy("owner").applyInArrow(_walk(turned, limit), "a long, b long"))
    return found[0].union(found[1])


def _classes(spark: SparkSession, rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Root of every fingerprint, and per root the component's id and its document to keep."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.min(place).alias("keeper"))
    classes = stored(spark, classes, "classes")
    roots = components(spark, links(spark, classes.select("fp"), limit))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", "keeper", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.min("keeper").alias("keeper"))
    return rooted.select("fp", "root"), least


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 4, limit: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    Fingerprints within ``limit`` bits are linked; the component is the smallest non-null
    ``doc_id`` reachable over links, the document itself included (null if there is none).
    Texts without words, null ones too, have fingerprint zero. Copies share one fingerprint and
    enter the join once; repeated rows stay repeated. An empty table gives no rows.
    """
    rows = stored(spark, with_fingerprint(docs, words), "fingerprints")
    rooted, least = _classes(spark, rows, limit)
    named = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def verdicts(spark: SparkSession, docs: DataFrame, words: int = 4, limit: int = 4) -> DataFrame:
    """Documents to treat apart when one of each component is kept: ``doc_id, content, n, kept``, a stored table.

    A document is its id and the md5 of its text (null as empty), ``n`` the number of its rows. It is listed if it
    goes, or if it is kept and has several rows; any other is the only one of its component to stay as
    it is. Kept is the one with the smallest id, those without an id last, and of several texts with that id
    the one with the smallest digest.
    """
    rows = stored(spark, with_fingerprint(docs, words), "fingerprints")
    _, least = _classes(spark, rows, limit)
    keep = stored(spark, least.select(F.col("keeper.doc_id").alias("id"), F.col("keeper.content").alias("digest")), "keep")
    documents = rows.groupBy("doc_id", "content").agg(F.count(F.lit(1)).alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("digest"))
    told = documents.join(keep, same, "left").withColumn("kept", F.col("digest").isNotNull())
    return stored(spark, told.where(~F.col("kept") | (F.col("n") > 1)).select("doc_id", "content", "n", "kept"), "verdicts")


def keepers(spark: SparkSession, docs: DataFrame, words: int = 4, limit: int = 4) -> DataFrame:
    """One document of each component as ``doc_id, content`` (md5 of its text, null as empty).

    It is the one with the smallest id, those without an id last, and of several texts with that id
    the one with the smallest digest.
    """
    rows = stored(spark, with_fingerprint(docs, words), "fingerprints")
    _, least = _classes(spark, rows, limit)
    return least.select("keeper.doc_id", "keeper.content")
