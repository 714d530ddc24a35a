"""Rounding and division with the dashboard's conventions.

The last digits of a sum of doubles depend on the order Spark adds it up in. Values are settled to
nine decimals before a rule that could turn on those digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def settled(value: Column) -> Column:
    return F.round(value, 9)


def half_even(value: Column, places: int = 0) -> Column:
    return F.bround(settled(value), places)


def truncate(value: Column) -> Column:
    return settled(value).cast("bigint")


def nearest_int(value: Column) -> Column:
    """Round half away from zero, as a SQL cast to integer does in the source warehouse."""
    return F.round(settled(value)).cast("int")


def floor_div(dividend: Column, divisor: Column) -> Column:
    """Division rounded down, NULL for a zero divisor."""
    return F.floor(dividend / F.nullif(divisor, F.lit(0)))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))
