"""Rounding rules that give the same digits as the SQL oracle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_scaled(c: Column, digits: int) -> Column:
    """``round(x, n)`` as ``round(x * 10^n, 0) / 10^n``.

    The scaled form rounds the same way in Spark and DuckDB; the direct
    ``round(x, n)`` differs in the last digit for some doubles.
    """
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def to_int_half_even(c: Column) -> Column:
    """double -> int with half-to-even rounding, as a SQL ``::int`` cast does.

    Spark's cast truncates. The inner 6-digit round removes last-bit noise of
    interpolated quantiles (545.4999999999999 -> 545.5) before the tie rule.
    """
    return F.bround(F.round(c, 6), 0).cast("int")
