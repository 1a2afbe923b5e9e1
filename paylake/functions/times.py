"""Wall-clock time expressions.

Payment times are wall-clock values without a zone, so they are parsed to
``timestamp_ntz``: days and hours then never depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def try_instant(text: Column) -> Column:
    """Wall-clock time of a text, NULL where it does not parse.

    Trap: an offset in the text is dropped, not applied. ``2025-05-02 01:00:00+05:30`` is 01:00 on
    May 2, as the local clock said, where a cast to an instant in UTC gives 19:30 on May 1.
    """
    return text.try_cast("timestamp_ntz")


def instant(text: str) -> Column:
    """Constant timestamp, folded by the optimizer."""
    return F.lit(text).cast("timestamp_ntz")


def seconds_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a wall-clock timestamp, fraction dropped."""
    return F.substring_index(ts.cast("string"), ".", 1)
