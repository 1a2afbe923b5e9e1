"""Token counts, token files and packing against the tokenizer libraries."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paylake.llm import bit_packing, packing, token_counts
from paylake.llm.memo import Memo, forget
from paylake.llm.vocabulary import WordEncoder, piece_counter, word_encoder
from paylake.session import scratch_path

BITS_AND_PIECES = st.lists(
    st.sampled_from(
        ["a", "Z", "word", " ", "  ", "\n", "\t", ".", ",", "'s", "'", "é", "É", "K", "İ", "ß", "Σ", "\x0b", "\x1c", "\x85",
         "\xa0", "1", "23", "<|endoftext|>", "<|ENDOFTEXT|>", "▁", "\x00", "中文", "!!", "x.'s", "ﬁ", "\U0001f600", "̸", "="]
    ),
    max_size=20,
).map("".join)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(BITS_AND_PIECES, st.text(max_size=40)), min_size=1, max_size=20))
def test_ids_and_counts_are_the_libraries_own(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, counts = word_encoder().encode(pa.array(texts, pa.string()))
    expected = [e.ids for e in word_encoder().library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected
    pieces = piece_counter().count(pa.array(texts, pa.string()))
    assert pieces.tolist() == [len(x) for x in piece_counter().library.encode(texts)]


def test_memo_stays_bounded_and_right():
    memo = Memo(lambda keys: [k * 2 for k in keys], limit=10)
    for i in range(100):
        keys = [str(i), str(i // 2), "always"]
        assert memo.get(keys) == [k * 2 for k in keys]
    assert len(memo.young) <= 13 and len(memo.old) <= 13
    forget()
    assert not memo.young and not memo.old and memo.get(["x"]) == ["xx"]


class Asked:
    """A tokenizer that notes what it is asked for."""

    def __init__(self, library):
        self.library, self.texts = library, []

    def __getattr__(self, name):
        def noted(asked, **options):
            self.texts += asked if isinstance(asked, list) else [asked]
            return getattr(self.library, name)(asked, **options)

        return noted


def test_chunks_seen_by_an_earlier_task_are_not_encoded_again():
    encoder = WordEncoder()
    encoder.library = asked = Asked(encoder.library)
    texts = pa.array(["some words, some Ünïcödé 123 wörds!!", "", "more words"])
    before = encoder.encode(texts)
    assert asked.texts
    asked.texts = []
    forget()  # a task's end
    after = encoder.encode(texts)
    assert not any(asked.texts)
    assert before[0].tolist() == after[0].tolist() and before[1].tolist() == after[1].tolist()
    encoder.encode(pa.array(["more words come"]))
    assert [t for t in asked.texts if t] == ["come"]


def test_kept_chunks_stay_few_and_short_and_their_ids_right(monkeypatch):
    monkeypatch.setattr(WordEncoder, "KEPT", 5)
    monkeypatch.setattr(WordEncoder, "KEPT_BYTES", 8)
    encoder = WordEncoder()
    for i in range(30):
        texts = [f"always {'abcdefghij'[i % 10] * (i % 13)} é{i // 2}. no{i}", "long" * (i + 1), "to " * i + "be"]
        ids, counts = encoder.encode(pa.array(texts))
        expected = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected
        assert len(encoder.kept) == len(encoder.kept_ids) <= 5
        assert encoder.kept[0].as_py() == "always" and max(len(k.as_py().encode()) for k in encoder.kept) <= 8


def test_blocks_of_a_batch_are_read_into_one_batch():
    texts = [("a b c", 7), ("", 7), ("some wörds", 9), ("no id", None), ("x" * 300, 11)]
    rows, first = [], 0
    for block, part in enumerate((texts[:2], texts[2:4], texts[4:])):
        ids = [encoded(t, 1) for t, _ in part]
        flat = np.array(sum(ids, []), np.uint32)
        rows.append(
            {"shard": 3, "block": block, "first": first, "n_tokens": len(flat), "bits": 16 + block, "first_doc": 7,
             "last_doc": 11, "doc_ids": [i for _, i in part], "doc_tokens": [len(x) for x in ids],
             "payload": bit_packing.pack(flat, 16 + block)}
        )
        first += len(flat)
    read = bit_packing.documents_of(pa.RecordBatch.from_pylist(rows, bit_packing.BLOCKS).slice(1))
    expected, at = [], 0
    for block, (text, i) in zip([0, 0, 1, 1, 2], texts, strict=True):
        ids = encoded(text, 1)
        expected.append({"shard": 3, "block": block, "doc_id": i, "first": at, "n_tokens": len(ids), "ids_crc32": crc(ids)})
        at += len(ids)
    assert read.to_pylist() == expected[2:]


def encoded(text, end):
    return [*word_encoder().library.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_counts_of_odd_documents(odd_docs):
    rows = token_counts.token_counts(odd_docs, limit=100).collect()
    texts = [r["text"] or "" for r in odd_docs.collect()]
    library = piece_counter().library
    expected = Counter((len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 100) for t in texts)
    assert Counter((r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == expected


def test_empty_tables(spark, empty_docs):
    assert token_counts.token_counts(empty_docs).collect() == []
    assert packing.pack_documents(spark, empty_docs).collect() == []
    path = scratch_path(spark, "test")
    bit_packing.write_tokens(empty_docs, path)
    assert bit_packing.read_documents(spark, path).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 20).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.integers(0, 2**b - 1), min_size=1, max_size=50))), st.data())
def test_packed_ids_come_back_from_any_place(packed, data):
    bits, ids = packed
    payload = bit_packing.pack(np.array(ids, np.uint32), bits)
    assert len(payload) == -(-len(ids) * bits // 8)
    start = data.draw(st.integers(0, len(ids) - 1))
    count = data.draw(st.integers(1, len(ids) - start))
    assert bit_packing.unpack(payload, bits, start, count).tolist() == ids[start : start + count]


def test_bits_of_a_vocabulary():
    assert [bit_packing.bits_for(n) for n in (1, 2, 3, 256, 257, 49_408)] == [1, 1, 2, 8, 9, 16]


def test_token_files_of_odd_documents(spark, odd_docs, monkeypatch):
    path = scratch_path(spark, "test")
    bit_packing.write_tokens(odd_docs, path)
    rows = bit_packing.read_documents(spark, path).collect()
    expected = Counter((r["doc_id"], len(encoded(r["text"], 1)), crc(encoded(r["text"], 1))) for r in odd_docs.collect())
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == expected
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == [sum(r["n_tokens"] for r in ordered[:i]) for i in range(len(ordered))]
    ids = [r["doc_id"] for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert bit_packing.read_ids(spark, path, 9) == [encoded("Ünïcödé wörds ﬁ 中文 \U0001f600 <|endoftext|>", 1)]
    assert len(bit_packing.read_ids(spark, path, 1)) == 3


def test_a_document_is_found_by_the_range_of_its_block(spark, docs, monkeypatch):
    monkeypatch.setattr(bit_packing, "BLOCK_TOKENS", 50)
    texts = [(i * 3, f"document number {i} has words of its own") for i in range(200)] + [(None, "no id"), (30, "again")]
    path = scratch_path(spark, "test")
    bit_packing.write_tokens(docs(*texts), path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = bit_packing.blocks_of(spark, path, 30)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(first_doc,30)" in plan and "GreaterThanOrEqual(last_doc,30)" in plan
    assert sorted(bit_packing.read_ids(spark, path, 30)) == sorted(encoded(t, 1) for i, t in texts if i == 30)
    assert bit_packing.read_ids(spark, path, 31) == [] and len(bit_packing.read_ids(spark, path, 597)) == 1
    ranges = bit_packing.read_blocks(spark, path).select("first_doc", "last_doc").collect()
    assert len(ranges) > 30 and sum((r["first_doc"] or 0) <= 300 <= (r["last_doc"] or -1) for r in ranges) <= 2


@settings(max_examples=150, deadline=None)
@given(
    st.dictionaries(st.integers(1, 64), st.integers(1, 200), min_size=1, max_size=25),
    st.integers(1, 64),
    st.sampled_from(["norm", "dot"]),
    st.integers(4096, 8192),
)
def test_plans_place_every_piece_once_within_all_limits(counts, most_pieces, rule, attention):
    limits = packing.Limits(64, most_pieces, attention, rule=rule)
    runs, made = packing.plan(counts, limits)
    ranks, bins = defaultdict(list), defaultdict(list)
    for length, rank, n, first, per, offset in runs:
        for j in range(n):
            ranks[length].append(rank + j)
            bins[first + j // per].append((offset + j % per * length, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    assert sorted(bins) == list(range(made))
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 64 and len(pieces) <= most_pieces
        assert sum(n * n for _, n in pieces) <= attention
    if most_pieces == 64 and attention >= 4096:
        # A sequence is opened only when no other holds the piece, so no two are half empty.
        assert made <= 2 * sum(n * c for n, c in counts.items()) / 64 + 1


def test_a_length_beyond_the_limits_is_refused():
    with pytest.raises(ValueError):
        packing.plan({65: 1}, packing.Limits(64, 8, 10_000))


def test_packing_of_odd_documents(spark, odd_docs):
    limits = packing.Limits(tokens=512, pieces=40, attention=512 * 512)
    rows = packing.pack_documents(spark, odd_docs, limits).collect()
    expected = Counter()
    for r in odd_docs.collect():
        ids = encoded(r["text"], 0)
        for start in range(0, len(ids), 512):
            part = ids[start : start + 512]
            expected[r["doc_id"], start // 512, start, len(part), crc(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 512 and len(pieces) <= 40


def test_packing_wastes_next_to_nothing(spark, small):
    rows = packing.pack_documents(spark, small[0]).collect()
    best = -(-sum(r["length"] for r in rows) // 2048)
    assert len({r["sequence_id"] for r in rows}) <= best * 1.01 + 1
