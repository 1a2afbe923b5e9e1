"""Minimax cuts and shards against brute force."""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import accumulate

from hypothesis import given, settings
from hypothesis import strategies as st

from paylake.llm import ordering, sharding


def fits(sizes, capacity, shards):
    used, left = 1, capacity
    for size in sizes:
        if size > capacity:
            return False
        if size > left:
            used, left = used + 1, capacity
        left -= size
    return used <= shards


def smallest(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(sizes, middle, shards) else (middle + 1, high)
    return low


SIZES = st.lists(st.one_of(st.integers(8, 40), st.integers(8, 3000)), min_size=1, max_size=400)


@settings(max_examples=200, deadline=None)
@given(SIZES, st.integers(1, 30), st.integers(1, 100))
def test_capacity_is_the_smallest_and_the_cuts_keep_to_it(sizes, shards, step):
    before = [0, *accumulate(sizes)]
    asked = []

    def fetch(places):
        asked.extend(places)
        return {i: before[i] for i in places}

    sums = sharding.PrefixSums(len(sizes), before[-1], step, fetch)
    capacity = sharding.minimax_capacity(sums, max(sizes), shards)
    assert capacity == smallest(sizes, shards)
    edges = [0, *sums.cuts(capacity, shards), len(sizes)]
    assert len(edges) == shards + 1 and edges == sorted(edges)
    assert max(before[b] - before[a] for a, b in zip(edges, edges[1:], strict=False)) == capacity
    assert len(asked) == len(set(asked))


def test_few_numbers_reach_the_driver():
    sizes = [8 + (i * 7919) % 5000 for i in range(300_000)]
    before = [0, *accumulate(sizes)]
    asked = []

    def fetch(places):
        asked.append(len(places))
        return {i: before[i] for i in places}

    sums = sharding.PrefixSums(len(sizes), before[-1], len(sizes) // (64 * 24), fetch)
    capacity = sharding.minimax_capacity(sums, max(sizes), 24)
    assert capacity == smallest(sizes, 24)
    sums.cuts(capacity, 24)
    assert sum(asked) < 40_000 and len(asked) < 40


def check(rows, found, shards=24):
    assert sorted((r["size"], r["text_crc32"]) for r in found) == sorted(
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in rows
    )
    slots, homes = defaultdict(list), defaultdict(set)
    sizes, firsts = defaultdict(int), {}
    for r in found:
        slots[r["shard"]].append(r["slot"])
        homes[r["text_crc32"]].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    for doc_id, text in rows:
        key = text or ""
        sizes[key] += len(key.encode()) + 8
        if doc_id is not None:
            firsts[key] = min(firsts.get(key, doc_id), doc_id)
    return sizes, firsts


def test_shards_of_small_documents(spark, small):
    df, rows = small
    found = sharding.shard_documents(spark, df).collect()
    sizes, firsts = check(rows, found)
    ordered = [sizes[key] for key in sorted(sizes, key=firsts.get)]
    by_shard = defaultdict(int)
    for r in found:
        by_shard[r["shard"]] += r["size"]
    assert max(by_shard.values()) == smallest(ordered, 24)
    assert {r["doc_id"] for r in found} == {i for i, _ in rows}


def test_shards_of_odd_documents(spark, odd_docs, empty_docs, docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check(rows, sharding.shard_documents(spark, odd_docs).collect())
    check(rows, sharding.shard_documents(spark, odd_docs, 2).collect(), 2)
    assert sharding.shard_documents(spark, empty_docs).collect() == []
    copies = docs(*["the same text"] * 50)
    assert len({r["shard"] for r in sharding.shard_documents(spark, copies).collect()}) == 1


def test_row_numbers_and_running_totals(spark):
    rows = [(i * 37 % 1000 // 10, i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    found = sorted(ordering.numbered(spark, df, ["k", "v"], "v", "test").collect(), key=lambda r: r["row_no"])
    assert [(r["k"], r["v"]) for r in found] == sorted(rows)
    assert [r["before"] for r in found] == [0, *accumulate(v for _, v in sorted(rows))][:-1]
    assert [r["row_no"] for r in found] == list(range(1000))
