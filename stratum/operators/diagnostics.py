"""Profiling queries a data engineer runs while chasing an incident.

All are single aggregations (map-side partial + one shuffle on the group
key) or top-k (``orderBy().limit()`` -> TakeOrderedAndProject: each task
keeps k rows, no global sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stratum.functions.normalize import strict_int


def value_distribution(df: DataFrame, c: str) -> DataFrame:
    """Count per value, NULL sorted last."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col(c).asc_nulls_last())


def op_counts(df: DataFrame, c: str = "op") -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).orderBy(c)


def duplicate_keys(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Top-k keys seen more than once (ties broken by key)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
            .orderBy(F.col("n").desc(), F.col(key).asc()).limit(k))


def rows_vs_distinct(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"))


def non_numeric_by_day(df: DataFrame, raw: str = "priority_raw", ts: str = "event_time") -> DataFrame:
    """Per day: records whose value is not an integer, and all records."""
    return (df.groupBy(F.to_date(ts).alias("day"))
            .agg(F.count_if(strict_int(raw).isNull()).alias("n_non_numeric"),
                 F.count(F.lit(1)).alias("n")))


def key_share_topk(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Top-k keys by row count and their share of all rows.

    The total is a scalar subquery, so no window over the whole table and no
    join are needed; the top-k keeps k rows per task.
    """
    total = df.agg(F.count(F.lit(1)).cast("double").alias("t")).scalar()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), F.col(key).asc()).limit(k)
    return top.select(key, "n", share_of(F.col("n"), total).alias("share"))


def share_of(n: Column, total: Column) -> Column:
    return F.round(n / total * F.lit(1e6), 0) / F.lit(1e6)
