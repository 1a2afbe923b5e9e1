"""Minimax contiguous sharding of atomic groups: the smallest capacity that fits, checked greedily."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm.ordering import numbered, stored

# A stretch of groups is looked into at so many places at once.
FAN_OUT = 64

# Gives, for group numbers, the bytes of all groups before each of them.
Fetch = Callable[[list[int]], dict[int, int]]


class PrefixSums:
    """What the driver knows of the running sizes of ordered groups: exact at some group numbers."""

    def __init__(self, n_groups: int, total: int, step: int, fetch: Fetch):
        self.fetch = fetch
        self.known = {0: 0, n_groups: total} | fetch(list(range(step, n_groups, step)))
        self._sort()

    def _sort(self) -> None:
        self.at = sorted(self.known)
        self.before = [self.known[i] for i in self.at]

    def exact(self, k: int) -> bool:
        return self.at[k + 1] == self.at[k] + 1

    def fill(self, capacity: int, shards: int, lucky: bool) -> tuple[bool, list[tuple[int, int]]]:
        """Greedy filling: whether the shards suffice, and where each of them but the last ends.

        An end is (index of the known place at or below it, bytes before it). Inside a stretch
        that is not known the lucky filling ends exactly full, the unlucky one at the stretch's start.
        """
        done, ends = 0, []
        for _ in range(shards):
            target = done + capacity
            if target >= self.before[-1]:
                return True, ends
            k = bisect_right(self.before, target) - 1
            end = target if lucky and not self.exact(k) else self.before[k]
            ends.append((k, end))
            if end <= done:
                return False, ends
            done = end
        return False, ends

    def fits(self, capacity: int, shards: int) -> bool:
        """Exact check; looks into the stretches in which the answer lies."""
        while True:
            best, lucky = self.fill(capacity, shards, True)
            sure, unlucky = self.fill(capacity, shards, False)
            if not best or sure:
                return best
            self.refine(
                k
                for (low, _), (high, _) in zip(unlucky, lucky, strict=False)
                for k in range(low, high + 1)
            )

    def cuts(self, capacity: int, shards: int) -> list[int]:
        """Number of the first group of every shard but the first, for a capacity that suffices.

        Among all cuts within the capacity these are the ones next to equal shares: each is as near to
        its share as the shard before it and the shards behind it allow.
        """
        while True:
            unknown: set[int] = set()
            total = self.before[-1]
            least, end = [0] * shards, total  # greedy from the end: the earliest start of each shard
            for j in range(shards - 1, 0, -1):
                least[j] = self._above(end - capacity, unknown)
                end = self.before[least[j]]
            cuts, at = [], 0
            for j in range(1, shards):
                most = self._below(self.before[at] + capacity, unknown)
                share = total * j // shards
                low = self._below(share, unknown)
                near = min((low, min(low + 1, len(self.at) - 1)), key=lambda k: abs(self.before[k] - share))
                at = max(at, min(most, max(least[j], near)))
                cuts.append(self.at[at])
            if not unknown:
                return cuts
            self.refine(unknown)

    def _below(self, target: int, unknown: set[int]) -> int:
        """Last place with at most ``target`` bytes before it; notes a stretch that hides it."""
        k = bisect_right(self.before, target) - 1
        if k + 1 < len(self.at) and self.before[k] != target and not self.exact(k):
            unknown.add(k)
        return k

    def _above(self, target: int, unknown: set[int]) -> int:
        """First place with at least ``target`` bytes before it; notes a stretch that hides it."""
        k = bisect_left(self.before, max(0, target))
        if k and self.before[k] != target and not self.exact(k - 1):
            unknown.add(k - 1)
        return k

    def refine(self, stretches) -> None:
        wanted = set()
        for k in set(stretches):
            first, last = self.at[k], self.at[k + 1]
            wanted.update(range(first + 1, last, max(1, (last - first) // FAN_OUT)))
        self.known |= self.fetch(sorted(wanted))
        self._sort()


def minimax_capacity(sums: PrefixSums, largest: int, shards: int) -> int:
    """Binary search of the smallest capacity for which greedy filling needs at most ``shards``."""
    low, high = max(largest, -(-sums.before[-1] // shards)), sums.before[-1]
    while low < high:
        middle = (low + high) // 2
        if sums.fits(middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 24) -> DataFrame:
    """Every document with its shard and its gapless slot there; equal texts share a shard.

    Groups of equal texts are ordered by their smallest ``doc_id`` and cut into contiguous shards
    of the smallest possible largest size (UTF-8 bytes plus 8 a row, law ``bytes``). Greedy filling finds
    that size; the cuts within it are the ones next to equal shares. A null text counts
    as empty. Within a shard, rows follow their groups and then ``doc_id``, nulls first. Repeated
    rows get a slot each. An empty table gives no rows. Shards can stay empty when groups are few or
    one is very large.

    The driver sees prefix sums only at about ``FAN_OUT`` places a shard and refines the
    stretches where a cut can fall, so it holds a few thousand numbers at any input size.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        spark,
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("content"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("content").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes"))
    groups = stored(spark, numbered(spark, groups, ["first_id", "content"], "bytes", "groups"), "groups")
    stats = groups.agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("total"), F.max("bytes").alias("largest")
    ).first()

    def fetch(places: list[int]) -> dict[int, int]:
        if not places:
            return {}
        asked = spark.createDataFrame(pa.table({"row_no": pa.array(places, pa.int64())}))
        found = groups.select("row_no", "before").join(F.broadcast(asked), "row_no")
        return {row["row_no"]: row["before"] for row in found.collect()}

    cuts: list[int] = []
    if stats["n"]:
        step = max(1, stats["n"] // (FAN_OUT * shards))
        sums = PrefixSums(stats["n"], stats["total"], step, fetch)
        cuts = sums.cuts(minimax_capacity(sums, stats["largest"], shards), shards)

    placed = rows.join(groups.select("content", F.col("row_no").alias("group_no")), "content")
    placed = numbered(spark, placed.drop("content"), ["group_no", "doc_id"], None, "slots")
    shard = sum((F.when(F.col("group_no") >= cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    placed = placed.withColumn("shard", shard.cast("int"))
    starts = placed.groupBy("shard").agg(F.min("row_no").alias("start"))
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row_no") - F.col("start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
