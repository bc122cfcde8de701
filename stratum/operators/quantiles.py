"""Exact quantiles per group by counting, for groups of any size.

``percentile`` holds a buffer of a group's distinct values in one task. Here the
values are counted first; each group's rank is then found in two steps: among
at most ``cells`` equal ranges of the value axis, and within the one range that holds
it. No task sees more of a group than the ranges' counts or the distinct values
of one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def grouped_quantile(df: DataFrame, group: Sequence[str], value: str, q: float, name: str = "quantile",
                     cells: int = 4096) -> DataFrame:
    """(group, ``name``): the interpolated ``q`` quantile of the non-null values, as ``percentile`` gives it.
    A group without a value gets NULL; NULL is a group value like any other."""
    keys = [f"_g{i}" for i in range(len(group))]
    # one row per group and distinct value, pre-aggregated in every task
    counts = (df.groupBy(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col(value).cast("double").alias("_v"))
                .agg(F.count(F.lit(1)).alias("_n")))
    bounds = df.agg(F.min(F.col(value).cast("double")).alias("lo"), F.max(F.col(value).cast("double")).alias("hi")).first()
    lo, width = bounds["lo"] or 0.0, ((bounds["hi"] or 0.0) - (bounds["lo"] or 0.0)) / cells or 1.0
    known = counts.where("_v is not null").withColumn("_cell", F.floor((F.col("_v") - lo) / width))
    per_cell = known.groupBy(*keys, "_cell").agg(F.sum("_n").alias("_c"))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (per_cell.withColumn("_end", F.sum("_c").over(upto)).withColumn("_total", F.sum("_c").over(whole))
                      .withColumn("_at", (F.col("_total") - 1) * q))
    # the two rows whose values are interpolated, each in the cell that holds it
    ranks = F.array(F.struct(F.lit(0).alias("side"), F.floor("_at").alias("rank")),
                    F.struct(F.lit(1).alias("side"), F.ceil("_at").alias("rank")))
    wanted = (placed.select(*keys, "_cell", "_at", (F.col("_end") - F.col("_c")).alias("_begin"), "_end", F.explode(ranks).alias("_r"))
                    .where((F.col("_r.rank") >= F.col("_begin")) & (F.col("_r.rank") < F.col("_end")))
                    .select(*[F.col(k).alias(f"w{k}") for k in keys], F.col("_cell").alias("_wcell"), "_at", F.col("_r.side").alias("_side"),
                            (F.col("_r.rank") - F.col("_begin")).alias("_rank")))
    here = F.col("_cell") == F.col("_wcell")
    for k in keys:
        here = here & F.col(k).eqNullSafe(F.col(f"w{k}"))
    inside = Window.partitionBy(*keys, "_cell", "_side").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = (known.join(wanted, here).withColumn("_end", F.sum("_n").over(inside))
                   .where((F.col("_rank") >= F.col("_end") - F.col("_n")) & (F.col("_rank") < F.col("_end"))))
    both = picked.groupBy(*keys).agg(F.max(F.when(F.col("_side") == 0, F.col("_v"))).alias("_lower"),
                                     F.max(F.when(F.col("_side") == 1, F.col("_v"))).alias("_upper"), F.max("_at").alias("_at"))
    share = F.col("_at") - F.floor("_at")
    answer = F.when(share == 0, F.col("_lower")).otherwise((1 - share) * F.col("_lower") + share * F.col("_upper"))
    found = both.select(*[F.col(k).alias(f"f{k}") for k in keys], answer.alias(name))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"f{k}"))
    groups = counts.select(*keys).distinct()
    return groups.join(found, same, "left").select(*[F.col(k).alias(g) for g, k in zip(group, keys)], name)
