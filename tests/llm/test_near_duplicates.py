"""SimHash, trie join, components and chunk fingerprints against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from paylake.llm import chunk_fingerprints as chunks
from paylake.llm import components as cc
from paylake.llm import simhash


def roots(n, pairs):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return [find(i) for i in range(n)]


def near_pairs(keys, limit):
    keys = [int(k) for k in keys]
    return [(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if (keys[i] ^ keys[j]).bit_count() <= limit]


def fingerprint(text, words=4):
    split = (text or "").encode().lower().split()
    parts = [split[i : i + words] for i in range(max(1, len(split) - words + 1))] if split else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(p), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


CLUSTERED = st.lists(
    st.tuples(st.integers(0, 3), st.lists(st.integers(0, 63), max_size=5)), min_size=1, max_size=60
)


def keys_of(clustered):
    centres = [0, 0xFFFFFFFFFFFFFFFF, 0x0123456789ABCDEF, 0xF0F0F0F00F0F0F0F]
    out = set()
    for centre, flips in clustered:
        key = centres[centre]
        for bit in flips:
            key ^= 1 << bit
        out.add(key)
    return np.array(sorted(out), np.uint64)


@settings(max_examples=80, deadline=None)
@given(CLUSTERED, st.sampled_from([2, 4]))
def test_two_tries_connect_what_all_pairs_connect(clustered, limit):
    keys = keys_of(clustered)
    pairs = []
    for turned in (False, True):
        own = np.sort(keys << np.uint64(32) | keys >> np.uint64(32)) if turned else keys
        i, j = simhash.trie_links(own, [(0, len(own), 0, len(own), 0, 0)], limit)
        back = (own << np.uint64(32) | own >> np.uint64(32)) if turned else own
        pairs += zip(np.searchsorted(keys, back[i]), np.searchsorted(keys, back[j]), strict=True)
    assert all((int(keys[i]) ^ int(keys[j])).bit_count() <= limit for i, j in pairs)
    assert roots(len(keys), pairs) == roots(len(keys), near_pairs(keys, limit))


@pytest.mark.parametrize("node_size", [4, 65_536])
def test_links_over_many_nodes(spark, monkeypatch, node_size):
    monkeypatch.setattr(simhash, "NODE_SIZE", node_size)
    random = np.random.default_rng(5)
    keys = set(random.integers(0, 2**63, 40).tolist())
    for key in list(keys)[:15]:
        for _ in range(8):  # clusters and chains of near keys
            for bit in random.integers(0, 64, 3):
                key ^= 1 << int(bit)
            keys.add(key)
    keys = np.array(sorted(keys), np.uint64)
    df = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "fp long")
    place = {int(k): i for i, k in enumerate(keys.view(np.int64))}
    found = [(place[r["a"]], place[r["b"]]) for r in simhash.links(spark, df, 4).collect()]
    assert roots(len(keys), found) == roots(len(keys), near_pairs(keys, 4))


def test_components_of_chains_stars_and_rings(spark):
    random = np.random.default_rng(3)
    order = random.permutation(60).tolist()
    pairs = [(order[i], order[i + 1]) for i in range(24)] + [(order[30], x) for x in order[31:45]]
    pairs += [(order[50 + i], order[50 + (i + 1) % 6]) for i in range(6)] + [pairs[0], (5, 5)]
    found = cc.components(spark, spark.createDataFrame(pairs, "a long, b long")).collect()
    expected = roots(60, pairs)
    assert {r["node"]: r["root"] for r in found} == {
        n: expected[n] for pair in pairs for n in pair if pair[0] != pair[1]
    }
    assert len(found) == len({r["node"] for r in found})
    assert cc.components(spark, spark.createDataFrame([], "a long, b long")).collect() == []


def test_simhash_of_small_documents(spark, small):
    df, rows = small
    prints = [fingerprint(text) for _, text in rows]
    expected = roots(len(rows), near_pairs(prints, 4))
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(spark, df).collect()}
    assert found == {
        doc_id: (f"{prints[i]:016x}", rows[expected[i]][0]) for i, (doc_id, _) in enumerate(rows)
    }


def test_simhash_of_odd_documents(spark, odd_docs, empty_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    prints = [fingerprint(t) for _, t in rows]
    linked = roots(len(rows), near_pairs(prints, 4))
    least = {root: min((rows[i][0] for i in range(len(rows)) if linked[i] == root and rows[i][0] is not None), default=None) for root in set(linked)}
    expected = Counter((rows[i][0], f"{prints[i]:016x}", least[linked[i]]) for i in range(len(rows)))
    found = simhash.near_duplicates(spark, odd_docs).collect()
    assert Counter(map(tuple, found)) == expected
    assert len(simhash.keepers(spark, odd_docs).collect()) == len(set(linked))
    assert simhash.near_duplicates(spark, empty_docs).collect() == []


def slow_ends(data: bytes, rules=chunks.Chunking()):
    """The same cuts, byte by byte."""
    begin, out = 0, []
    while begin < len(data):
        stop = min(len(data), begin + rules.most)
        cut = stop
        for i in range(begin + rules.least - 1, stop):
            value = 0
            for j in range(chunks.REACH):
                value += int(chunks._GEAR[data[i - j]]) << j
            bits = rules.strict_bits if i + 1 < begin + rules.normal else rules.loose_bits
            if (value & 0xFFFF) >> (16 - bits) == 0:
                cut = i + 1
                break
        out.append(cut)
        begin = cut
    return out


def test_chunk_ends_are_those_found_byte_by_byte(small):
    texts = [text for _, text in small[1][:25]] + ["", "a", "z" * 700]
    raw = [t.encode() for t in texts]
    places = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    ends = chunks.chunk_ends(np.frombuffer(b"".join(raw), np.uint8), places)
    assert [(e - b).tolist() for e, b in zip(ends, places, strict=False)] == [slow_ends(r) for r in raw]


def test_an_insertion_changes_few_chunks(small):
    text = max((t for _, t in small[1]), key=len)
    first, second = chunks.chunk_sets([text, text[:1000] + "some words put in" + text[1000:]])
    assert chunks.containment(first, second) > 1 - 400 / len(text)
    assert chunks.decoded(chunks.encoded(first)) == first
    assert chunks.containment({}, {}) == 1 and chunks.containment({}, first) == 0


def expected_comparison(rows):
    """Brute force over (doc_id, text) rows in ring order."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        a, b, c = chunks.chunk_sets([text, changed, following])
        digest = hashlib.sha256(changed.encode()).hexdigest()
        near = chunks.containment(a, b), chunks.containment(a, c)
        out.append((doc_id, len(text), digest, chunks.encoded(a), chunks.encoded(b), *near))
    return out


def test_edits_of_small_documents(spark, small):
    rows = sorted(small[1], reverse=True)
    found = chunks.compare_with_edits(spark, small[0]).collect()
    assert sorted(map(tuple, found)) == sorted(expected_comparison(rows))


def test_edits_of_odd_documents(spark, odd_docs, empty_docs, docs):
    rows = [(r["doc_id"], r["text"] or "") for r in odd_docs.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()), reverse=True)
    found = chunks.compare_with_edits(spark, odd_docs).collect()
    assert Counter(map(tuple, found)) == Counter(expected_comparison(rows))
    assert chunks.compare_with_edits(spark, empty_docs).collect() == []
    one = chunks.compare_with_edits(spark, docs("only one")).collect()
    assert one[0]["near_next"] == 1
