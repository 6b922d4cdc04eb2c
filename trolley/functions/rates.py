"""Percentages and their rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, 0 where ``whole`` is not positive."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def round2_text(value: Column) -> Column:
    """Two decimals as text, rounded half to even on the exact binary value.

    ``bround`` rounds the shortest decimal form instead: 1 of 4,000 is
    0.025000000000000001 % as a double, so it must become 0.03, but ``bround``
    sees a tie and gives 0.02.
    """
    return F.call_function("format_number", value, F.lit("0.00"))


def round2(value: Column) -> Column:
    return round2_text(value).cast("double")


def rate_decimal(value: Column) -> Column:
    """The rounded rate for a ``decimal(5,2)`` column, NULL where it overflows.

    A NULL made this way is reported by the constraint check of the table.
    """
    return round2_text(value).try_cast("decimal(5,2)")


def conversion_rate(views: Column, purchases: Column) -> Column:
    return round2(percent(purchases, views))


def buyer_rate(buyers: Column, window_shoppers: Column) -> Column:
    return percent(buyers, buyers + window_shoppers)
