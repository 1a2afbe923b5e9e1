"""Token files: ids in the fewest bits of the vocabulary, in blocks that can be read alone."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from paylake.llm import arrow
from paylake.llm.vocabulary import SLICE_BYTES, WORDS, word_encoder

# Ids in one block; a longer document is a block of its own.
BLOCK_TOKENS = 8192

BLOCKS = pa.schema(
    [
        ("shard", pa.int32()),  # files follow each other in the order of shards
        ("block", pa.int64()),  # place in the shard
        ("first", pa.int64()),  # ids in the shard before the block
        ("n_tokens", pa.int64()),
        ("bits", pa.int32()),
        ("first_doc", pa.int64()),
        ("last_doc", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)
READ = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int64()),
        ("doc_id", pa.int64()),
        ("first", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def bits_for(vocabulary_size: int) -> int:
    """Bits of the largest id."""
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids of ``bits`` bits each, most significant bit first, filled up with zeros to a byte."""
    if bits == 16:
        return ids.astype(">u2").tobytes()
    wide = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(wide, axis=1)[:, 32 - bits :]).tobytes()


def unpack(payload, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from the ``start``-th on; only their own bytes are touched."""
    first, last = start * bits, (start + count) * bits
    data = np.frombuffer(payload, np.uint8)[first // 8 : -(-last // 8)]
    if bits == 16:
        return data.view(">u2").astype("<u4")
    flat = np.unpackbits(data)[first % 8 :][: count * bits].reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, 32 - bits :] = flat
    return np.packbits(wide, axis=1).view(">u4").ravel().astype("<u4")


def write_tokens(docs: DataFrame, path: str, end_id: int = 1, vocabulary: str = WORDS) -> None:
    """Encode whole texts, append ``end_id`` and write blocks in ascending ``doc_id`` order.

    The container is a Parquet folder with one row per block, so any store Spark can write
    works and a lost task is written again as a whole. Null texts count as empty, null ids come
    first, and rows with one ``doc_id`` are ordered by text; every row is written.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie", "text")
        .select("doc_id", "text")
    )

    def write(batches):
        shard = TaskContext.get().partitionId()
        encoder = word_encoder(vocabulary)
        bits = bits_for(max(encoder.library.get_vocab_size(), end_id + 1))
        block = first = 0
        for batch in arrow.text_slices(batches, limit=SLICE_BYTES):
            ids, counts = encoder.encode(arrow.texts(batch))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, np.uint32(end_id))
            ends = ends + np.arange(1, len(ends) + 1)
            doc_ids = batch.column("doc_id")
            rows: dict[str, list] = {name: [] for name in BLOCKS.names}
            at = done = 0
            while at < len(ends):
                to = max(at + 1, int(np.searchsorted(ends, done + BLOCK_TOKENS, side="right")))
                part = ids[done : ends[to - 1]]
                rows["shard"].append(shard)
                rows["block"].append(block)
                rows["first"].append(first)
                rows["n_tokens"].append(len(part))
                rows["bits"].append(bits)
                own = doc_ids.slice(at, to - at).to_pylist()  # ascending, null ones first
                rows["first_doc"].append(next((i for i in own if i is not None), None))
                rows["last_doc"].append(own[-1])
                rows["doc_ids"].append(own)
                rows["doc_tokens"].append(np.diff(ends[at:to], prepend=done).tolist())
                rows["payload"].append(pack(part, bits))
                block, first, at, done = block + 1, first + len(part), to, int(ends[to - 1])
            yield arrow.table(BLOCKS, **rows)

    arrow.map_batches(ordered, write, BLOCKS).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(from_arrow_schema(BLOCKS)).parquet(path)


def shard_starts(blocks: DataFrame) -> DataFrame:
    """Ids of all earlier shards; one row per shard."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocks.groupBy("shard")
        .agg(F.sum("n_tokens").alias("n"))
        .select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    )


def documents_of(blocks: pa.RecordBatch) -> pa.RecordBatch:
    """The documents of all blocks of a batch, in one batch of ``READ``."""
    n_docs = pc.list_value_length(blocks.column("doc_ids")).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(blocks.num_rows), n_docs)
    sizes = blocks.column("doc_tokens").flatten().to_numpy()
    ends = np.cumsum(sizes)
    n_tokens = blocks.column("n_tokens").to_numpy()
    in_block = ends - sizes - (np.cumsum(n_tokens) - n_tokens)[row]
    sums, at = np.zeros(len(row), np.int64), 0
    bits = blocks.column("bits").to_pylist()
    for payload, width, n, docs in zip(blocks.column("payload"), bits, n_tokens, n_docs, strict=True):
        ids = unpack(payload.as_buffer(), width, 0, n)
        for k in range(at, at + docs):
            sums[k] = zlib.crc32(ids[in_block[k] : in_block[k] + sizes[k]])
        at += docs
    return arrow.table(
        READ,
        shard=blocks.column("shard").take(pa.array(row)),
        block=blocks.column("block").take(pa.array(row)),
        doc_id=blocks.column("doc_ids").flatten(),
        first=blocks.column("first").to_numpy()[row] + in_block,
        n_tokens=sizes,
        ids_crc32=sums,
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every written document, from the files alone.

    ``start`` counts the ids of all documents before it over all files. Shard totals, one
    row per file, are the only thing gathered.
    """
    blocks = read_blocks(spark, path)

    def unpack_blocks(batches):
        for batch in batches:
            yield documents_of(batch)

    found = arrow.map_batches(blocks, unpack_blocks, READ)
    starts = F.broadcast(shard_starts(blocks.select("shard", "n_tokens")))
    return found.join(starts, "shard").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def blocks_of(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The blocks that hold rows of one document."""
    asked = F.lit(doc_id).cast("long")
    around = read_blocks(spark, path).where((F.col("first_doc") <= asked) & (F.col("last_doc") >= asked))
    return around.where(F.array_contains("doc_ids", asked))


def read_ids(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of one document (of each row with that id), reading only its block.

    Blocks are in the order of their ids, so the statistics of the files and of their pages on the first and
    last id of a block leave few pages to be read.
    """
    block = blocks_of(spark, path, doc_id)
    out = []
    for row in block.orderBy("shard", "block").toLocalIterator():
        ends = np.cumsum(row["doc_tokens"])
        for each, size, end in zip(row["doc_ids"], row["doc_tokens"], ends, strict=True):
            if each == doc_id:
                out.append(unpack(row["payload"], row["bits"], int(end) - size, size).tolist())
    return out
