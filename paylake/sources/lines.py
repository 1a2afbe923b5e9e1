"""Order lines as text, with values that a declared table must not take."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paylake.schemas import ORDER_LINES

# Column, modulus, remainder and the text that its value is replaced by; rules of the test input, not of the load.
BROKEN = (
    ("l_linenumber", 101, 3, "99999999999"),
    ("l_partkey", 89, 5, None),
    ("l_suppkey", 97, 7, "n/a"),
    ("l_returnflag", 83, 11, "RR"),
    ("l_shipdate", 79, 13, "2024-02-30 00:00:00"),
)


def broken_lines(lineitem: DataFrame) -> DataFrame:
    """The declared columns of the order lines as text; some lines break one rule, some several."""
    text = {field.name: F.col(field.name).cast("string") for field in ORDER_LINES.fields}
    text["l_shipdate"] = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    for name, modulus, remainder, value in BROKEN:
        text[name] = F.when(F.col("l_orderkey") % modulus == remainder, F.lit(value)).otherwise(text[name])
    return lineitem.select(*[column.alias(name) for name, column in text.items()])
