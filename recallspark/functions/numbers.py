"""Rounding and exact averages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_even(c: Column, digits: int) -> Column:
    """Round half to even on the scaled double (Spark's ``round`` is half-up)."""
    scale = float(10 ** digits)
    return F.rint(c * scale) / scale


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, rounded; null when the whole is 0."""
    return round_even(F.try_divide(part, whole) * 100.0, digits)


def mean_of_cents(c: Column) -> Column:
    """Average of a two-decimal column by way of whole hundredths: integer sums give the same
    result in any task order, where a sum of doubles may differ in the last bits."""
    return F.try_divide(F.sum(F.rint(c * 100).cast("long")), F.count(c)) / 100.0
