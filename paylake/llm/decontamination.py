"""Benchmark decontamination: Wu-Manber search for many word windows at once.

Symbols are words. The last block of a few words under the cursor gives the shift: how far
every window can be skipped. At shift zero the block's bucket gives the windows that end
with it, the first block is compared by hash and the words themselves confirm the occurrence.
Many cursors, one for each stretch of a document, move together as one numpy array.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import arrow
from paylake.llm.ordering import small_side, stored
from paylake.llm.words import Words

WINDOW = 10
BLOCK_WORDS = 3
# Window ends that one cursor covers.
STRETCH = 64
# Text searched at once.
SLICE_BYTES = 1 << 19
# Benchmark text searched in one pass; a larger benchmark takes several passes.
PASS_BYTES = 8 << 20
# Windows in one stretch of an item, the unit that passes are made of.
STRETCH_WINDOWS = 4096

_MIX = np.uint64(0xD6E8FEB86659FD93)


def blocks(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that end at each word."""
    out = hashes.copy()
    for back in range(1, size):
        out[back:] = out[back:] * _MIX + hashes[: len(hashes) - back]
    return out ^ (out >> np.uint64(29))


@dataclass
class Tables:
    """Search tables for windows of one length."""

    length: int
    block: int
    bits: int
    shift: np.ndarray  # by the upper bits of a block's hash
    bucket: np.ndarray  # hashes of last blocks, sorted; one entry per window
    prefix: np.ndarray  # hash of the window's first block, in the same order
    windows: list[bytes]  # the words, joined by blanks
    items: list[list[str]]  # benchmark items that hold the window


def windows_of(text: str | None, size: int = WINDOW) -> list[list[bytes]]:
    """Windows of an item: ``size`` consecutive words, or all words of a shorter item."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    words = Words(raw, np.array([0, len(raw)]))
    low = words.lowered.tobytes()
    parts = [low[a:b] for a, b in zip(words.start, words.end, strict=True)]
    if not parts:
        return []
    return [parts[i : i + size] for i in range(max(1, len(parts) - size + 1))]


def build_tables(benchmark: list[tuple[object, str | None]], size: int = WINDOW) -> list[Tables]:
    """One set of tables for each window length; a null item id is written as ``null``."""
    holders: dict[bytes, set[str]] = defaultdict(set)
    for item_id, text in benchmark:
        for window in windows_of(text, size):
            holders[b" ".join(window)].add("null" if item_id is None else str(item_id))
    by_length: dict[int, list[bytes]] = defaultdict(list)
    for window in holders:
        by_length[window.count(b" ") + 1].append(window)
    out = []
    for length, windows in sorted(by_length.items()):
        block = min(BLOCK_WORDS, length)
        raw = np.frombuffer(b" ".join(windows), np.uint8)
        words = Words(raw, np.array([0, len(raw)]))
        keys = blocks(words.hash, block).reshape(-1, length)
        bits = max(10, (16 * keys.size - 1).bit_length())
        shift = np.full(1 << bits, length - block + 1, np.int16)
        for at in range(block - 1, length):
            np.minimum.at(shift, keys[:, at] >> np.uint64(64 - bits), length - 1 - at)
        order = np.argsort(keys[:, -1], kind="stable")
        out.append(
            Tables(
                length,
                block,
                bits,
                shift,
                keys[order, -1],
                keys[order, block - 1],
                [windows[i] for i in order],
                [sorted(holders[windows[i]]) for i in order],
            )
        )
    return out


def occurrences(words: Words, tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Every (last word, window) at which a window occurs inside one text."""
    n = tables.length
    first, last = words.first[:-1], words.first[1:]
    long_enough = last - first >= n
    begin, stop = first[long_enough] + n - 1, last[long_enough]
    parts = -(-(stop - begin) // STRETCH)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    at = np.repeat(begin, parts) + nth * STRETCH
    limit = np.minimum(at + STRETCH, np.repeat(stop, parts))
    keys = blocks(words.hash, tables.block)
    shifts = tables.shift[keys >> np.uint64(64 - tables.bits)]
    found = [np.zeros(0, np.int64)]
    while len(at):
        step = shifts[at]
        found.append(at[step == 0])
        at = at + np.maximum(step, 1)
        going = at < limit
        at, limit = at[going], limit[going]
    ends = np.concatenate(found)
    # Windows in the bucket of the block, by their first block, then by their words.
    low = np.searchsorted(tables.bucket, keys[ends], "left")
    many = np.searchsorted(tables.bucket, keys[ends], "right") - low
    place = np.repeat(ends, many)
    window = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    likely = keys[place - n + tables.block] == tables.prefix[window]
    place, window = place[likely], window[likely]
    if not len(place):
        return place, window
    text, start, end = words.joined()
    same = [
        text[a:b] == tables.windows[w]
        for a, b, w in zip(start[place - n + 1], end[place], window, strict=True)
    ]
    return place[same], window[same]


def stretches(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``benchmark`` with each item cut into stretches of ``STRETCH_WINDOWS`` windows, so that none is long.

    The text of a stretch is its words, lower-cased and with a blank between them; stretches of an item overlap by
    the words that windows across a border need. Items without words have no stretch.
    """
    schema = pa.schema([("item_id", pa.string()), ("text", pa.string())])

    def run(batches):
        for batch in arrow.text_slices(batches):
            words = Words(*arrow.raw_bytes(arrow.texts(batch)))
            text, start, end = words.joined()
            rows, parts = [], []
            for row, (first, last) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                windows = max(1, last - first - size + 1) if last > first else 0
                for at in range(first, first + windows, STRETCH_WINDOWS):
                    stop = min(last, at + STRETCH_WINDOWS + size - 1)
                    rows.append(row)
                    parts.append(text[start[at] : end[stop - 1]].decode())
            yield arrow.table(schema, item_id=batch.column("item_id").take(pa.array(rows, pa.int64())), text=parts)

    return arrow.map_batches(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text"), run, schema)


def _search(names: list[str], column: str, shared, schema: pa.Schema, hits_only: bool = False):
    """Adds the occurrences of one pass to the struct ``column``; with ``hits_only``, of rows that have any."""
    kind = schema.field(column).type

    def run(batches):
        for batch in arrow.text_slices(batches, "text", SLICE_BYTES):
            words = Words(*arrow.raw_bytes(arrow.texts(batch)))
            edge = np.zeros(len(words.start) + 1, np.int64)
            items: dict[int, set[str]] = defaultdict(set)
            if column in batch.schema.names:
                for i, old in enumerate(batch.column(column).to_pylist()):
                    if old is None:
                        continue
                    items[i].update(old["items"])
                    for span in old["spans"]:
                        edge[words.first[i] + span["first"]] += 1
                        edge[words.first[i] + span["end"]] -= 1
            for tables in shared.value:
                place, window = occurrences(words, tables)
                np.add.at(edge, place - tables.length + 1, 1)
                np.add.at(edge, place + 1, -1)
                rows = np.searchsorted(words.first, place, side="right") - 1
                for row, w in zip(rows.tolist(), window.tolist(), strict=True):
                    items[row].update(tables.items[w])
            hit = np.cumsum(edge[:-1]) > 0
            change = hit.copy()
            change[1:] = hit[1:] != hit[:-1]
            inner = words.first[1:-1]
            inner = inner[(inner > 0) & (inner < len(hit))]
            change[inner] = hit[inner] | hit[inner - 1]  # spans end with their text
            places = np.flatnonzero(change)
            spans: dict[int, list[dict]] = defaultdict(list)
            for a, b in zip(places, np.append(places[1:], len(hit)), strict=False):
                if hit[a]:
                    row = int(np.searchsorted(words.first, a, side="right")) - 1
                    base = words.first[row]
                    spans[row].append({"first": int(a - base), "end": int(b - base)})
            count = np.diff(words.first)
            value = [
                {"n_words": int(count[i]), "spans": spans.get(i, []), "items": sorted(items.get(i, ()))}
                for i in range(batch.num_rows)
            ]
            found = pa.RecordBatch.from_arrays(
                [batch.column(name) for name in names] + [pa.array(value, kind)], schema=schema
            )
            yield found.take(pa.array(sorted(spans), pa.int64())) if hits_only else found

    return run


def _hits(found: list[DataFrame], column: str) -> DataFrame:
    """One row for each text that passes hit: ``_content`` and all they found as one struct ``column``.

    Equal texts have equal hits in a pass, so they come once a task before anything is shuffled, and
    a text has a row a pass at most.
    """
    hits = None
    for one in found:
        once = one.groupBy("_content").agg(F.first(column).alias(column))
        hits = once if hits is None else hits.unionByName(once)
    together = hits.groupBy("_content").agg(F.collect_list(column).alias("_all"))
    return together.select(
        "_content",
        F.struct(
            F.col("_all")[0]["n_words"].alias("n_words"),
            F.flatten(F.col("_all.spans")).alias("spans"),
            F.array_distinct(F.flatten(F.col("_all.items"))).alias("items"),
        ).alias(column),
    )


def find_benchmark(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, column: str = "contamination", size: int = WINDOW
) -> DataFrame:
    """``docs`` with a struct ``column``: ``n_words``, ``spans`` of hit words and ``items`` that occur.

    Letters A-Z are lower-cased; words are runs of ASCII letters, digits and characters above ASCII.
    Spans are disjoint, count words from 0 and exclude their end. Null and empty texts have no words and no
    hits, benchmark rows without words occur nowhere, and repeated item ids count once. Every row and
    every column of ``docs`` stays; ``column`` must not be among them. A benchmark beyond ``PASS_BYTES`` is
    searched in several passes over the documents, so tasks and driver hold one part of it at a time. All passes
    but the last write the texts they hit by digest, with spans and items; texts themselves are never written,
    and meet those hits before the last pass: in a broadcast if their measured size allows it, else in one shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = docs.columns
    # Repeated rows hash alike, so they would all come in one pass.
    benchmark = stored(spark, stretches(benchmark, size).distinct(), "benchmark")
    total = benchmark.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    passes = max(1, -(-total // PASS_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
            ("items", pa.list_(pa.string())),
        ]
    )
    schema = to_arrow_schema(docs.schema).append(pa.field(column, kind))

    def tables(i: int):
        own = benchmark.where(part == i).collect()  # about PASS_BYTES
        return spark.sparkContext.broadcast(build_tables([tuple(row) for row in own], size))

    if passes > 1:
        content = F.md5(F.coalesce(docs["text"], F.lit("")))
        texts = docs.select(content.alias("_content"), "text")
        small = pa.schema([("_content", pa.string()), ("text", pa.string()), pa.field(column, kind)])
        found = []
        for i in range(passes - 1):
            search = _search(["_content", "text"], column, tables(i), small, hits_only=True)
            found.append(stored(spark, arrow.map_batches(texts, search, small).drop("text"), "hits"))
        # Written, as its size is measured and AQE splits a skewed join only when both sides come straight from a shuffle.
        hits = stored(spark, _hits(found, column), "contamination")
        spans, items = F.size(f"{column}.spans"), F.array_join(f"{column}.items", ",")
        listed = small_side(hits, spans * 16 + F.octet_length(items) + F.size(f"{column}.items") * 16 + 128)
        docs = docs.join(listed, content == listed["_content"], "left").select(*[docs[name] for name in names], listed[column])
    return arrow.map_batches(docs, _search(names, column, tables(passes - 1), schema), schema)


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document with the numbers and the digest of what ``find_benchmark`` found."""
    found = find_benchmark(spark, docs.select("doc_id", "text"), benchmark, "found")
    n_hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def sql(size: int = WINDOW) -> str:
    """The same report for DuckDB, by joining every window of every document with those of the items."""
    words = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    split = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{words}')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, {split} AS words FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {split} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(words), {size}) AS n, words[i : i + least(len(words), {size}) - 1] AS w
  FROM (SELECT *, unnest(range(1, greatest(len(words) - {size} + 1, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
places AS (
  SELECT row_no, n, i, words[i : i + n - 1] AS w
  FROM (SELECT row_no, n, words, unnest(range(1, len(words) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)),
found AS (SELECT row_no, p.n, i, item FROM places p JOIN windows x ON p.n = x.n AND p.w = x.w),
hits AS (SELECT row_no, count(DISTINCT place) AS n_hit FROM (SELECT row_no, unnest(range(i, i + n)) AS place FROM found) GROUP BY 1),
held AS (SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
         FROM (SELECT DISTINCT row_no, item FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (row_no) LEFT JOIN held USING (row_no)
"""
