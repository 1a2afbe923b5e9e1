"""Document fingerprints: content-defined chunks, their digests and their lengths.

A gear hash over the last 16 bytes decides where a chunk ends: with a strict mask up to the
normal length and a loose one beyond it, so lengths stay near normal. Chunk ends depend on nearby
bytes alone, so an insertion shifts the chunks behind it without changing them.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import arrow

# Bytes that the gear hash reaches back; no chunk is shorter, so none depends on what is before it.
REACH = 16
_GEAR = np.random.default_rng(20240611).integers(0, 1 << 16, 256, dtype=np.uint16)


@dataclass(frozen=True)
class Chunking:
    least: int = REACH
    normal: int = 48
    most: int = 192
    strict_bits: int = 7
    loose_bits: int = 4


def chunk_ends(flat: np.ndarray, places: np.ndarray, rules: Chunking = Chunking()) -> list[np.ndarray]:
    """Ends of the chunks of each text in ``flat``; all texts are cut in step, one chunk at a time."""
    n = len(flat)
    gear = _GEAR[flat]
    width = 1
    while width < REACH:
        shifted = gear.copy()
        shifted[width:] += gear[:-width] << np.uint16(width)
        gear, width = shifted, width * 2
    nexts = []
    for bits in (rules.strict_bits, rules.loose_bits):
        hit = gear >> np.uint16(16 - bits) == 0
        after = np.where(hit, np.arange(n, dtype=np.int64), n)
        nexts.append(np.append(np.minimum.accumulate(after[::-1])[::-1], n))
    strict, loose = nexts
    at, end = places[:-1].copy(), places[1:]
    row = np.flatnonzero(end > at)
    rows, cuts = [], []
    while len(row):
        begin, stop = at[row], end[row]
        cut = strict[np.minimum(begin + rules.least - 1, n)] + 1
        late = cut >= begin + rules.normal
        cut[late] = loose[np.minimum(begin[late] + rules.normal - 1, n)] + 1
        cut = np.minimum(np.minimum(cut, begin + rules.most), stop)
        rows.append(row)
        cuts.append(cut)
        at[row] = cut
        row = row[cut < stop]
    if not rows:
        return [np.zeros(0, np.int64)] * len(end)
    rows, cuts = np.concatenate(rows), np.concatenate(cuts)
    order = np.lexsort((cuts, rows))
    return np.split(cuts[order], np.searchsorted(rows[order], np.arange(1, len(end))))


def chunk_sets(texts: list[str], rules: Chunking = Chunking()) -> list[dict[int, int]]:
    """For each text, the digests of its chunks with the chunks' lengths."""
    raw = [text.encode("utf-8", "surrogatepass") for text in texts]
    data = b"".join(raw)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    places = np.concatenate([[0], np.cumsum(sizes)])
    digest = xxhash.xxh3_64_intdigest
    out = []
    for begin, ends in zip(places.tolist(), chunk_ends(np.frombuffer(data, np.uint8), places, rules), strict=False):
        chunks = {}
        for end in ends.tolist():
            chunks[digest(data[begin:end])] = end - begin
            begin = end
        out.append(chunks)
    return out


def encoded(chunks: dict[int, int]) -> str:
    """A fingerprint as text: all digests in ascending order, then their chunks' lengths, in base64."""
    digests = np.fromiter(chunks.keys(), np.uint64, len(chunks))
    lengths = np.fromiter(chunks.values(), np.uint16, len(chunks))
    order = np.argsort(digests)
    raw = digests[order].astype("<u8").tobytes() + lengths[order].astype("<u2").tobytes()
    return base64.b64encode(raw).decode()


def decoded(fingerprint: str) -> dict[int, int]:
    raw = base64.b64decode(fingerprint)
    n = len(raw) // 10
    return dict(zip(np.frombuffer(raw[: 8 * n], "<u8").tolist(), np.frombuffer(raw[8 * n :], "<u2").tolist(), strict=True))


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Bytes in chunks of both, as a share of the smaller one; two empty texts are alike, one is not."""
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    if len(b) < len(a):
        a, b = b, a
    return sum(n for digest, n in a.items() if digest in b) / min(sum(a.values()), sum(b.values()))


OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the beginning of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _compare(batches):
    """Rows in order, each followed by its next document; ``extra`` rows are only next ones."""
    held: list[tuple] = []
    for batch in arrow.text_slices(batches):
        rows = held + list(
            zip(
                batch.column("extra").to_pylist(),
                batch.column("doc_id").to_pylist(),
                batch.column("text").to_pylist(),
                strict=True,
            )
        )
        held = rows[-1:]
        own = [i for i in range(len(rows) - 1) if not rows[i][0]]
        chunks = chunk_sets([row[2] for row in rows])
        changed = [edited(rows[i][2], rows[i + 1][2]) for i in own]
        changed_chunks = chunk_sets(changed)
        yield arrow.table(
            OUT,
            doc_id=[rows[i][1] for i in own],
            n_chars=[len(rows[i][2]) for i in own],
            edited_sha256=[hashlib.sha256(text.encode()).hexdigest() for text in changed],
            fingerprint=[encoded(chunks[i]) for i in own],
            edited_fingerprint=[encoded(each) for each in changed_chunks],
            near_edited=[containment(chunks[i], each) for i, each in zip(own, changed_chunks, strict=True)],
            near_next=[containment(chunks[i], chunks[i + 1]) for i in own],
        )


def followed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Rows in descending ``doc_id`` by partition, each partition ending with the first row of the next.

    Columns are ``doc_id, text, extra``; the ring closes from the last partition to the first.
    Quantiles of the ids give the partitions' borders, so texts are shuffled once. Only one border and one
    first row (an id and a digest) per partition reach the driver. Null ids come last, rows
    with one id are ordered by the text's digest, and null texts count as empty.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    borders = rows.select("doc_id").approxQuantile("doc_id", shares, 0.2 / parts) if shares else []
    splits = [float("-inf"), *(sorted(set(borders)) or [0.0]), float("inf")]
    bucket = Bucketizer(splits=splits, inputCol="_id", outputCol="_bucket", handleInvalid="keep")
    rows = bucket.transform(rows.withColumn("_id", F.col("doc_id").cast("double")))
    last = len(splits) - 2
    # Invalid, that is null, ids get the number behind the last bucket.
    number = F.when(F.col("doc_id").isNull(), last + 1).otherwise(last - F.col("_bucket").cast("int"))
    rows = rows.select("doc_id", "text", number.alias("part"), F.md5("text").alias("content"))
    firsts = sorted(
        (row["part"], row["first"])
        for row in rows.groupBy("part").agg(F.max(F.struct("doc_id", "content")).alias("first")).collect()
    )
    ring = [
        (part, first["doc_id"], first["content"], firsts[i - 1][0]) for i, (part, first) in enumerate(firsts)
    ]
    heads = spark.createDataFrame(ring, "part int, head_id long, head_content string, before int")
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("content") == F.col("head_content"))
    here = F.struct(F.col("part").alias("to"), F.lit(False).alias("extra"))
    there = F.struct(F.col("before").alias("to"), F.lit(True).alias("extra"))
    sent = (
        rows.join(F.broadcast(heads), "part")
        .withColumn("sent", F.explode(F.when(is_head, F.array(here, there)).otherwise(F.array(here))))
        .select("doc_id", "text", "content", "sent.to", "sent.extra")
    )
    return (
        sent.repartitionById(last + 2, "to")
        .sortWithinPartitions("to", "extra", F.desc_nulls_last("doc_id"), F.desc("content"))
        .select("doc_id", "text", "extra")
    )


def compare_with_edits(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and of its edited text, with their likeness.

    The edited text has the last third of its code points replaced by the beginning of the
    next document in descending ``doc_id``; after the last comes the first, which for a single
    row is itself. Null texts count as empty and have the empty fingerprint. Repeated rows are
    rows of their own, next to each other. An empty table gives no rows.
    """
    return arrow.map_batches(followed(spark, docs), _compare, OUT)
