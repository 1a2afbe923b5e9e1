"""Small helpers around ``mapInArrow``: bounded slices of text, and text as flat bytes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from paylake.llm.memo import forget
from paylake.llm.workers import ship

# One slice holds about this much text, or a single row where that is longer.
SLICE_BYTES = 4 << 20


def text_slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds about ``limit`` bytes of ``column``.

    Memory that Arrow keeps from the slice before goes back first.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            pa.default_memory_pool().release_unused()
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column with null read as empty."""
    return pc.fill_null(batch.column(column), "")


def raw_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all strings in a row, and the n + 1 places where strings begin and end."""
    wide = strings.cast(pa.large_binary())
    places = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[places[0] : places[-1]], places - places[0]


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of ``schema`` from arrays or lists."""
    return pa.RecordBatch.from_arrays(
        [
            columns[field.name]
            if isinstance(columns[field.name], pa.Array)
            else pa.array(columns[field.name], field.type)
            for field in schema
        ],
        schema=schema,
    )


def _trim() -> None:
    """Let the C library hand freed memory back, where it is one that keeps it."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(df: DataFrame, run, schema: pa.Schema) -> DataFrame:
    """``mapInArrow`` with an Arrow schema.

    Python workers outlive their tasks, so what a task used is handed back at its end.
    """
    ship(df.sparkSession)

    def run_and_release(batches):
        try:
            yield from run(batches)
        finally:
            forget()
            gc.collect()
            pa.default_memory_pool().release_unused()
            _trim()

    return df.mapInArrow(run_and_release, from_arrow_schema(schema))


def map_slices(
    df: DataFrame, transform, schema: pa.Schema, column: str = "text", limit: int = SLICE_BYTES
) -> DataFrame:
    """Run ``transform(batch)`` over bounded slices; it returns one batch of ``schema``."""

    def run(batches):
        for batch in text_slices(batches, column, limit):
            yield transform(batch)

    return map_batches(df, run, schema)
