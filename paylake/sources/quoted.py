"""CSV records with line breaks inside quotes, from files that stay splittable.

Whether a line break ends a record depends on the quotes before it in the file. Two passes replace the one
task a file that Spark's multi-line reader needs. The first counts quotes for each split, so a running sum over
the few splits of a file tells whether a split begins inside quotes. The second joins the lines of a
split to records. What a record has in more than one split, a piece at the end of one and the beginning of
the next, is put together by a shuffle of these pieces alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from paylake.schemas import MALFORMED
from paylake.sources.files import CSV_OPTIONS, read_csv

QUOTE = CSV_OPTIONS["quote"]
FILE = "_file"
# A piece is a whole record, or the beginning, the middle or the end of one.
WHOLE, BEGINS, WITHIN, ENDS = range(4)
PIECES = "_file string, _block bigint, _first boolean, kind int, record string"
ARROW_PIECES = pa.schema(
    [(FILE, pa.string()), ("_block", pa.int64()), ("_first", pa.bool_()), ("kind", pa.int32()), ("record", pa.string())]
)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in file order within a task, with the file and the split that they are read from."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("_block")
    )


def split_quotes(spark: SparkSession, path: str) -> DataFrame:
    """Per split: its lines with an odd number of quotes, and whether it begins inside quotes.

    One row for each split, as the driver lists them to plan the scan.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    splits = _lines(spark, path).groupBy(FILE, "_block").agg(F.count_if(quotes % 2 == 1).alias("odd_lines"))
    before = Window.partitionBy(FILE).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("inside", F.coalesce(F.sum("odd_lines").over(before), F.lit(0)) % 2 == 1)


def begins_inside(spark: SparkSession, path: str) -> dict[tuple[str, int], bool] | None:
    """Which splits begin inside quotes, or None where every record is one line.

    A record of several lines has an odd number of quotes in the first and in the last of them.
    """
    splits = split_quotes(spark, path).collect()
    if not any(row["odd_lines"] for row in splits):
        return None
    return {(row[FILE], row["_block"]): row["inside"] for row in splits}


class _Split:
    """The record that a split has open at the end of a batch."""

    def __init__(self, inside: bool):
        self.lines: list[str] = []
        self.inside = inside
        # The open record began in an earlier split.
        self.cut = inside
        self.fresh = True


def _records(inside: dict[tuple[str, int], bool]):
    """Joins lines to records, split by split; batches hold lines of one or several splits in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, split = None, None

        def rows(found: list[tuple[int, str, bool]]) -> pa.RecordBatch:
            kinds, texts, firsts = zip(*found, strict=True)
            file, block = at
            n = len(found)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file]).take(pa.array(np.zeros(n, np.int64))),
                    pa.array(np.full(n, block, np.int64)),
                    pa.array(firsts, pa.bool_()),
                    pa.array(kinds, pa.int32()),
                    pa.array(texts, pa.string()),
                ],
                schema=ARROW_PIECES,
            )

        def close() -> list[tuple[int, str, bool]]:
            """The record that the end of a split cuts off."""
            if split is None or not split.lines:
                return []
            return [(WITHIN if split.cut else BEGINS, "\n".join(split.lines), split.fresh)]

        for batch in batches:
            blocks, files = batch.column("_block").to_numpy(), batch.column(FILE)
            borders = np.flatnonzero(np.append(True, np.diff(blocks) != 0))
            changed = pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)).to_numpy(zero_copy_only=False)
            borders = np.union1d(borders, np.flatnonzero(changed) + 1).astype(int).tolist()
            for begin, end in zip(borders, [*borders[1:], batch.num_rows], strict=True):
                key = files[begin].as_py(), int(blocks[begin])
                if key != at:
                    if left := close():
                        yield rows(left)
                    at, split = key, _Split(inside[key])
                part = batch.column("value").slice(begin, end - begin)
                quotes = pc.count_substring(part, QUOTE).to_numpy(zero_copy_only=False)
                open_after = (np.cumsum(quotes) + split.inside) % 2 == 1
                ends = np.flatnonzero(~open_after)
                texts = part.to_pylist()
                found, start = [], 0
                for stop in ends.tolist():
                    lines = texts[start : stop + 1]
                    if split.lines:
                        lines = split.lines + lines
                        split.lines = []
                    kind = ENDS if split.cut else WHOLE
                    found.append((kind, lines[0] if len(lines) == 1 else "\n".join(lines), split.fresh))
                    split.cut = split.fresh = False
                    start = stop + 1
                split.lines += texts[start:]
                split.inside = bool(open_after[-1])
                if found:
                    yield rows(found)
        if left := close():
            yield rows(left)

    return run


def records(spark: SparkSession, path: str, inside: dict[tuple[str, int], bool]) -> DataFrame:
    """All records of the CSV files as text (``_file``, ``_first``, ``record``); ``_first`` is that of a file.

    Records end at a line feed outside quotes; a carriage return before it is not part of the record, line
    breaks inside quotes stay as they are. A quote that is never closed makes the rest of its file one record.
    """
    pieces = _lines(spark, path).mapInArrow(_records(inside), PIECES)
    whole = pieces.filter(F.col("kind") == WHOLE)
    # A piece that begins a record starts a new number; those that follow in the file belong to it.
    order = Window.partitionBy(FILE).orderBy("_block", F.desc("kind"))
    parts = pieces.filter(F.col("kind") != WHOLE).withColumn("_nth", F.count_if(F.col("kind") == BEGINS).over(order))
    joined = (
        parts.groupBy(FILE, "_nth")
        .agg(F.array_sort(F.collect_list(F.struct("_block", "record", "_first"))).alias("parts"))
        .select(
            FILE,
            F.get("parts._block", F.lit(0)).alias("_block"),
            F.get("parts._first", F.lit(0)).alias("_first"),
            F.array_join("parts.record", "\n").alias("record"),
        )
    )
    every = whole.select(FILE, "_block", "_first", "record").union(joined)
    text = F.regexp_replace("record", "\r$", "")
    return every.select(FILE, (F.col("_first") & (F.col("_block") == 0)).alias("_first"), text.alias("record"))


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``files.read_csv`` for files whose quoted fields may hold line breaks.

    Files without such fields are left to Spark's scan after one pass that counts quotes. For others the
    rows have their file in ``_file``, every file must begin with a header of the declared columns
    in order, or the scan fails, and blank records are skipped. A record with more or fewer fields than
    declared keeps its text in ``_malformed_line``.
    """
    inside = begins_inside(spark, path)
    if inside is None:
        return read_csv(spark, path, schema)
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"} | {"columnNameOfCorruptRecord": MALFORMED}
    text = F.from_csv("record", ", ".join(f"_{i} string" for i in range(len(schema.fields))), options)
    names = F.array(*[text[f"_{i}"] for i in range(len(schema.fields))])
    wrong = F.raise_error(F.concat(F.lit("CSV header is not the declared columns: "), F.col("record")))
    is_data = (
        F.when(~F.col("_first"), True)
        .when(names == F.array(*[F.lit(field.name) for field in schema.fields]), False)
        .otherwise(wrong.cast("boolean"))
    )
    rows = records(spark, path, inside).filter(is_data).filter(F.col("record").rlike(r"\S"))
    declared = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema.fields)
    parsed = F.from_csv("record", f"{declared}, {MALFORMED} string", options).alias("_row")
    return rows.select(FILE, parsed).select("_row.*", FILE)
