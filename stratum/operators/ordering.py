"""Places and ranks in a global order without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratum.session import scratch_dir, sized_partitions

_BITS = 33  # monotonically_increasing_id: partition number above, row number in it below


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of the shared folder: its rows are fixed and its lineage ends there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered_rows(df: DataFrame, label: str, name: str = "_row") -> DataFrame:
    """``df`` written with a number per row, which tells repeated rows apart."""
    return written(df.withColumn(name, F.monotonically_increasing_id()), label)


def placed(df: DataFrame, order: Sequence[str | Column], label: str, name: str = "_at",
           running: str | None = None, rows_per_task: int = 2_000_000) -> DataFrame:
    """A written ``df`` with ``name``: every row's place in ``order``, from 0. Rows equal in ``order`` get places
    in any order.

    With ``running`` (a column of integers) also ``_run``: its sum over the row and all before it.
    Rows are range-partitioned and sorted; the only table that one task sees whole has a row per partition.
    """
    n = sized_partitions(df, rows_per_task)
    at = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                   .withColumn("_mid", F.monotonically_increasing_id()), label)
    at = at.withColumn("_part", F.shiftright("_mid", _BITS)).withColumn("_in", F.col("_mid").bitwiseAND(F.lit((1 << _BITS) - 1)))
    sums = [F.count(F.lit(1)).alias("_n"), (F.sum(running) if running else F.lit(0)).cast("long").alias("_s")]
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = (at.groupBy(F.col("_part").alias("_p")).agg(*sums)
               .select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
                       F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0")))
    out = at.join(F.broadcast(parts), F.col("_part") == F.col("_p")).withColumn(name, F.col("_n0") + F.col("_in"))
    if running:
        inside = Window.partitionBy("_part").orderBy("_in").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn("_run", F.col("_s0") + F.sum(running).over(inside))
    return out.drop("_mid", "_part", "_in", "_p", "_n0", "_s0")
