"""Numeric expressions with the rounding and zero rules spelled out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paylake.schemas import MONEY


def try_money(text: Column) -> Column:
    """Text to decimal(18,2); NULL when it is not a number."""
    return text.try_cast(MONEY)


def rounded_int(value: Column) -> Column:
    """Float to int by rounding half to even (a plain Spark cast truncates)."""
    return F.rint(value).cast("int")


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient; NULL on a zero denominator instead of an ANSI error."""
    return F.round(F.try_divide(numerator, denominator), digits)


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole) * 100, 2)
