"""Time predicates and differences.

Predicates keep the bare column on one side so that Catalyst can push them
to the Parquet reader (row-group min/max) and to partition pruning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _ts(value: str | dt.date | dt.datetime) -> Column:
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = f"{value.isoformat()} 00:00:00"
    elif len(value) == 10:
        value = f"{value} 00:00:00"
    return F.lit(value).cast("timestamp_ntz")


def in_window(c: Column | str, start, end) -> Column:
    """Half-open ``start <= c < end`` on a timestamp column."""
    col = F.col(c) if isinstance(c, str) else c
    return (col >= _ts(start)) & (col < _ts(end))


def day_slice(c: Column | str, day: str | dt.date) -> Column:
    """``day <= c < day + 1 day`` — the sargable form of a day filter."""
    d = dt.date.fromisoformat(day) if isinstance(day, str) else day
    return in_window(c, d, d + dt.timedelta(days=1))


def on_day_wrapped(c: Column | str, day: str | dt.date) -> Column:
    """The non-sargable form ``date_format(c) = 'yyyy-MM-dd'`` (for contrast)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd") == F.lit(str(day))


def add_seconds(c: Column, seconds: Column | int) -> Column:
    q = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.timestamp_add("SECOND", q, c)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end`` (sub-second parts ignored,
    like a boundary count at second granularity)."""
    return (F.unix_timestamp(F.date_trunc("second", end).cast("timestamp"))
            - F.unix_timestamp(F.date_trunc("second", start).cast("timestamp")))


def hours_crossed(start: Column, end: Column) -> Column:
    """Hour boundaries crossed from ``start`` to ``end`` (00:59 -> 01:01 is 1).

    ``timestampdiff`` counts full hours instead, which is a different number.
    """
    return ((F.unix_timestamp(F.date_trunc("hour", end).cast("timestamp"))
             - F.unix_timestamp(F.date_trunc("hour", start).cast("timestamp"))) / 3600).cast("long")
