"""Text expressions: fingerprints, zero-padded ids, masks, portable buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed values.
FINGERPRINT_DELIMITER = "||"
MASK_PREFIX = "XXXXXXXX"
MASK_VISIBLE_CHARS = 4


def row_fingerprint(columns: Sequence[str], null_marker: str | None = None) -> Column:
    """SHA-256 over the delimiter-joined columns.

    ``concat_ws`` skips NULLs, so ``(a, NULL, b)`` and ``(a, b, NULL)`` share a
    fingerprint. Pass ``null_marker`` to keep NULL positions apart.
    """
    parts = [F.col(name) for name in columns]
    if null_marker is not None:
        parts = [F.coalesce(part, F.lit(null_marker)) for part in parts]
    return F.sha2(F.concat_ws(FINGERPRINT_DELIMITER, *parts), 256)


def padded_id(prefix: str, width: int, number: Column) -> Column:
    """``prefix`` plus a number from 0 on, zero-padded to at least ``width`` digits.

    Longer numbers keep all digits. Padding the decimal text takes half the time of
    ``format_string`` per row.
    """
    digits = number.cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))
    return F.concat(F.lit(prefix), padded)


def mask_tail(value: Column) -> Column:
    """Hide all but the last characters. NULL stays NULL; short values stay whole."""
    return F.concat(F.lit(MASK_PREFIX), F.right(value, F.lit(MASK_VISIBLE_CHARS)))


def mask_tail_sql(value: str) -> str:
    """The same mask as SQL text, for views."""
    return f"concat('{MASK_PREFIX}', right({value}, {MASK_VISIBLE_CHARS}))"


def hash_bucket(value: Column, buckets: int) -> Column:
    """Bucket number from MD5, equal in every engine that has MD5."""
    head = F.substring(F.md5(value.cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("long") % F.lit(buckets)
