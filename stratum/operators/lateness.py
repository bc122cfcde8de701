"""Late-arrival measurement and the lookback it implies.

The delay is counted in whole seconds (boundaries crossed). Events are first
counted per delay, on all tasks; the exact ``percentile`` then reads one row
per distinct delay, a few hundred thousand for a range of days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from stratum.functions.timefn import add_seconds, hours_crossed, seconds_between

DAY_SECONDS = 86400
QUANTILES = [0.5, 0.95, 0.99]


def _days6(c: Column) -> Column:
    """Seconds -> days, rounded to 6 decimals (scaled form)."""
    return F.round(c / F.lit(float(DAY_SECONDS)) * F.lit(1e6), 0) / F.lit(1e6)


def is_late(event_time: Column, arrived: Column, days: int = 1) -> Column:
    return arrived > add_seconds(event_time, days * DAY_SECONDS)


def lateness_profile(events: DataFrame, ts: str = "event_time", arrived: str = "_ingested_at") -> DataFrame:
    """P50 / P95 / P99 / max delay in days and the share arriving > 1 day late."""
    delay = seconds_between(F.col(ts), F.col(arrived))
    late = F.when(is_late(F.col(ts), F.col(arrived)), 1).otherwise(0)
    # first one row per distinct delay (partial sums on every task), then the quantiles of those counts
    per = events.groupBy(delay.alias("_d")).agg(F.count(F.lit(1)).alias("_n"), F.sum(late).alias("_l"))
    return per.agg(
        F.percentile("_d", QUANTILES, F.col("_n")).alias("_q"),
        F.max("_d").alias("_max"),
        (F.sum("_l") / F.sum("_n")).alias("_late"),
    ).select(
        _days6(F.col("_q")[0]).alias("p50_days"),
        _days6(F.col("_q")[1]).alias("p95_days"),
        _days6(F.col("_q")[2]).alias("p99_days"),
        _days6(F.col("_max")).alias("max_days"),
        (F.round(F.col("_late") * F.lit(1e6), 0) / F.lit(1e6)).alias("late_ratio"),
    )


def lateness_histogram(events: DataFrame, ts: str = "event_time", arrived: str = "_ingested_at") -> DataFrame:
    """Rows per delay in hour boundaries crossed."""
    return (events.groupBy(hours_crossed(F.col(ts), F.col(arrived)).alias("delay_hours"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("delay_hours"))


def recommended_lookback(events: DataFrame, ts: str = "event_time", arrived: str = "_ingested_at") -> DataFrame:
    """Smallest whole-day lookback that covers the P99 delay (one row)."""
    prof = lateness_profile(events, ts, arrived)
    return prof.select("p99_days", "max_days",
                       F.ceil(F.col("p99_days")).cast("int").alias("lookback_days"))


def lookback_days_value(events: DataFrame, ts: str = "event_time", arrived: str = "_ingested_at") -> int:
    """The same number on the driver (a single-row result)."""
    row = recommended_lookback(events, ts, arrived).first()
    return int(row["lookback_days"]) if row and row["lookback_days"] is not None else 0


def lookback_start(target_max_day: dt.date | None, lookback_days: int,
                   cap: dt.date | None = None) -> dt.date | None:
    """First day to recompute: ``max(event_date of target) - lookback``.

    ``cap`` guards against one far-future day freezing the window
    (``least(max, cap)``); default keeps the plain rule.
    """
    if target_max_day is None:
        return None
    top = min(target_max_day, cap) if cap is not None else target_max_day
    return top - dt.timedelta(days=lookback_days)

