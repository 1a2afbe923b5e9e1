"""Token counts: pieces per distinct pre-token joined to pre-token frequencies, without ids."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from paylake.llm import arrow
from paylake.llm.vocabulary import PIECES, piece_counter

COUNTS = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
)


def token_counts(docs: DataFrame, limit: int = 4096, vocabulary: str = PIECES) -> DataFrame:
    """Bytes and tokens of every whole text, without begin, end or added special tokens.

    One row per input row, repeated rows included. Null and empty texts have no bytes and
    no tokens; a null ``doc_id`` stays null. Columns other than ``doc_id`` and ``text`` are
    not read. ``over_limit`` is true above ``limit`` tokens. There is no shuffle: a task
    holds one slice of text and a bounded memo of pre-tokens.
    """

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        strings = arrow.texts(batch)
        counts = pa.array(piece_counter(vocabulary).count(strings))
        return arrow.table(
            COUNTS,
            doc_id=batch.column("doc_id").cast(pa.int64()),
            n_bytes=pc.binary_length(strings).cast(pa.int64()),
            n_tokens=counts,
            over_limit=pc.greater(counts, limit),
        )

    return arrow.map_slices(docs.select("doc_id", "text"), count, COUNTS)
