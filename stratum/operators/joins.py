"""Joins used by the models and their diagnostics.

No explicit broadcast hints on tables that grow with the data: Catalyst
broadcasts a side only when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` (a checked bound), and AQE re-plans
to a broadcast or splits skewed partitions at runtime. Small sides whose
size is bounded by construction (a day index, a partition count) say so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def enrich(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, cols: list[str]) -> DataFrame:
    """Inner equi join to a dimension, keeping the named dimension columns."""
    d = dim.select(F.col(dim_key).alias(fact_key), *cols)
    return fact.join(d, fact_key, "inner")


def flag_from(fact: DataFrame, flagged: DataFrame, key: str, flag: str) -> DataFrame:
    """Left join to a distinct key set -> boolean flag (never NULL)."""
    marks = flagged.select(key).distinct().withColumn("_hit", F.lit(True))
    return (fact.join(marks, key, "left")
            .withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))


def restrict_to(fact: DataFrame, picked: DataFrame, key: str) -> DataFrame:
    """Semi join: rows of ``fact`` whose key is in ``picked`` (no row
    multiplication, however often a key repeats in ``picked``)."""
    return fact.join(picked.select(key), key, "left_semi")


def day_index(ts_col: str, epoch: str) -> F.Column:
    return F.datediff(F.to_date(F.col(ts_col)), F.lit(epoch).cast("date"))


def follow_day(orders: DataFrame, epoch: str = "1995-01-01") -> DataFrame:
    """Equi join on a computed key: each order to the order day that is
    1-3 days later (``least(idx + 1 + key % 3, max idx)``), if that day exists.

    The day dimension has one row per calendar day (bounded by the time
    span, not the row count); the join itself is a plain equi join on the
    computed column.
    """
    days = orders.select(day_index("o_orderdate", epoch).alias("day_idx"),
                         F.to_date("o_orderdate").alias("follow_day")).distinct()
    max_idx = days.agg(F.max("day_idx")).scalar()
    target = F.least(day_index("o_orderdate", epoch) + 1 + F.col("o_orderkey") % 3, max_idx)
    keyed = orders.select("o_orderkey", target.alias("day_idx"))
    return keyed.join(days, "day_idx", "inner").select("o_orderkey", "follow_day")


def expand_range(df: DataFrame, n: F.Column, name: str = "i") -> DataFrame:
    """Lateral range expansion: one row per i in [0, n). n <= 0 gives no rows."""
    seq = F.when(n > 0, F.sequence(F.lit(0).cast("long"), (n - 1).cast("long")))
    return df.select("*", F.explode(seq).alias(name))
