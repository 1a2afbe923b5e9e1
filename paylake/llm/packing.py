"""Best-fit packing of documents into training sequences, over counts of equal sizes.

Pieces of one length are interchangeable, so the packing is planned over at most
``capacity`` (length, count) pairs on the driver and carried out by rank: the r-th piece of a
length goes where the plan puts it. The plan's size depends on the capacity, not on the corpus.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import arrow
from paylake.llm.ordering import numbered, stored
from paylake.llm.vocabulary import WORDS, word_encoder

PIECE_ROWS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most: tokens, pieces and attention cost (sum of squared lengths)."""

    tokens: int = 2048
    pieces: int = 2048
    attention: int = 2048 * 2048
    # Weight of each residual in the score of a bin.
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001)
    rule: str = "norm"  # or "dot"

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.pieces, self.attention], np.int64)


def plan(counts: dict[int, int], limits: Limits) -> tuple[list[tuple], int]:
    """Vector best-fit, longest lengths first; returns runs and the number of sequences.

    A run (length, first rank, pieces, first sequence, pieces per sequence, offset) places
    pieces by rank. Sequences with equal residuals form one class; a length goes to the
    class with the smallest weighted residual norm (rule "norm") or the largest weighted dot product
    of demand and residual (rule "dot") among those that hold it under every limit. A length
    that no limit allows raises ValueError.
    """
    full = limits.vector()
    weights = np.array(limits.weights)
    runs: list[tuple] = []
    open_bins: dict[tuple[int, int, int], list[list[int]]] = {}
    made = 0
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        if (need > full).any():
            raise ValueError(f"a piece of {length} tokens exceeds the limits {limits}")
        rank, left = 0, counts[length]

        def put(bins: list[list[int]], residual: np.ndarray, left: int, rank: int) -> tuple[int, int]:
            """Fill bins one after the other, each until the length no longer fits."""
            most = int((residual[need > 0] // need[need > 0]).min())
            offset = int(full[0] - residual[0])
            while left and bins:
                first, n = bins.pop()
                whole = min(n, left // most)
                if whole:
                    runs.append((length, rank, whole * most, first, most, offset))
                    keep(residual - most * need, first, whole)
                    rank, left = rank + whole * most, left - whole * most
                if left and whole < n:  # less than a full share is left
                    runs.append((length, rank, left, first + whole, left, offset))
                    keep(residual - left * need, first + whole, 1)
                    rank, left, whole = rank + left, 0, whole + 1
                if whole < n:
                    bins.append([first + whole, n - whole])
            return left, rank

        def keep(residual: np.ndarray, first: int, n: int) -> None:
            if (residual > 0).all():
                open_bins.setdefault(tuple(int(x) for x in residual), []).append([first, n])

        if open_bins:
            classes = np.array(list(open_bins), np.int64)
            classes = classes[(classes >= need).all(axis=1)]
            if limits.rule == "norm":
                score = (((classes - need) / full) ** 2 * weights).sum(axis=1)
            else:
                score = -((classes / full) * (need / full) * weights).sum(axis=1)
            for k in np.argsort(score, kind="stable"):
                if not left:
                    break
                key = tuple(int(x) for x in classes[k])
                bins = open_bins.pop(key)
                left, rank = put(bins, classes[k], left, rank)
                if bins:
                    open_bins.setdefault(key, []).extend(bins)
        if left:
            most = int((full[need > 0] // need[need > 0]).min())
            fresh = -(-left // most)
            put([[made, fresh]], full, left, rank)
            made += fresh
    return runs, made


def pieces(docs: DataFrame, limit: int, end_id: int = 0, vocabulary: str = WORDS) -> DataFrame:
    """Encode whole texts, append ``end_id`` and cut what is longer than ``limit``.

    Null texts count as empty: one piece that holds the end id alone.
    """

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = word_encoder(vocabulary).encode(arrow.texts(batch))
        ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id)).astype("<u4", copy=False)
        counts = counts + 1
        n_pieces = -(-counts // limit)
        row = np.repeat(np.arange(len(counts)), n_pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        start = piece * limit
        length = np.minimum(limit, counts[row] - start)
        at = np.repeat(np.cumsum(counts) - counts, n_pieces) + start
        sums = [zlib.crc32(ids[a : a + n]) for a, n in zip(at, length, strict=True)]
        return arrow.table(
            PIECE_ROWS,
            doc_id=batch.column("doc_id").cast(pa.int64()).take(pa.array(row)),
            piece=piece.astype(np.int32),
            start=start,
            length=length,
            ids_crc32=sums,
        )

    return arrow.map_slices(docs.select("doc_id", "text"), cut, PIECE_ROWS)


def pack_documents(
    spark: SparkSession,
    docs: DataFrame,
    limits: Limits = Limits(),
    end_id: int = 0,
    vocabulary: str = WORDS,
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset`` there.

    Pieces are ranked within their length by (doc_id, piece) in a range-partitioned sort, so a
    length that a third of all pieces share is no hot group. Repeated rows are packed each.
    An empty table gives no rows.
    """
    cut = pieces(docs, min(limits.tokens, int(limits.attention**0.5)), end_id, vocabulary)
    # Stored first: the range partitioning samples its input, which would encode it twice.
    cut = stored(spark, cut, "pieces")
    ranked = numbered(spark, cut, ["length", "doc_id", "piece", "ids_crc32"], None, "ranked")
    # At most one row per possible length.
    counts = {row["length"]: row["n"] for row in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = plan(counts, limits)
    lengths = np.array(sorted(counts), np.int64)
    sizes = np.array([counts[n] for n in lengths.tolist()], np.int64)
    firsts = np.cumsum(sizes) - sizes
    begin = dict(zip(lengths.tolist(), firsts.tolist(), strict=True))
    # Rows are ranked over all lengths: a run's place is that of its length plus its rank.
    table = np.array(sorted((begin[n] + rank, seq, per, offset) for n, rank, _, seq, per, offset in runs), np.int64).reshape(-1, 4)
    shared = spark.sparkContext.broadcast(table)
    out = pa.schema([*PIECE_ROWS, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches):
        plan_rows = shared.value
        for batch in batches:
            row_no = batch.column("row_no").to_numpy()
            run = plan_rows[np.searchsorted(plan_rows[:, 0], row_no, side="right") - 1]
            nth = row_no - run[:, 0]
            length = batch.column("length").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in PIECE_ROWS.names]
                + [pa.array(run[:, 1] + nth // run[:, 2]), pa.array(run[:, 3] + nth % run[:, 2] * length)],
                schema=out,
            )

    return arrow.map_batches(ranked.select(*PIECE_ROWS.names, "row_no"), place, out)
