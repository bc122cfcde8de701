"""Deterministic samples, disjoint splits and surrogate ids.

None of these uses a global ``row_number() over (order by ..)``, which
would pull every row into one task. A sample is found by counting: a histogram of
the hash says below which bucket every row is in and which single bucket holds the
last ones; only that bucket's rows are put in order, by range partitions. Ranks
and surrogate ids are places in range partitions plus the partitions' offsets. So
a sample of half the table costs no task more than its share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratum.operators.ordering import placed
from stratum.session import checkpoint_root, sized_partitions


# --- fixed value: buckets of the hash histogram, the most that comes to the driver ---
HASH_BUCKETS = 4096


def hash_rank_key(key: str) -> list[Column]:
    """Sort key of a hash sample: md5 of the key's text, then the key."""
    return [F.md5(F.col(key).cast("string")), F.col(key)]


def _hash_bucket(key: str) -> Column:
    """Bucket of the hash by its leading three hex digits, in hash order; a NULL key hashes to NULL, which sorts first."""
    digits = F.substring(F.md5(F.col(key).cast("string")), 1, 3)
    return F.coalesce(F.conv(digits, 16, 10).cast("int"), F.lit(-1))


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones on every run (of rows with equal keys, any)."""
    counts = {r["b"]: r["n"] for r in df.groupBy(_hash_bucket(key).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    below, edge = 0, None
    for b in sorted(counts):
        if below + counts[b] > n:
            edge = b
            break
        below += counts[b]
    if edge is None:  # n rows or fewer in all
        return df
    whole = df.where(_hash_bucket(key) < edge)
    last = placed(df.where(_hash_bucket(key) == edge), hash_rank_key(key), "sample-edge")
    return whole.unionByName(last.where(F.col("_at") < n - below).drop("_at"))


def disjoint_splits(df: DataFrame, key: str, sizes: dict[str, int]) -> DataFrame:
    """Consecutive slices of one hash ranking: first ``sizes[0]`` rows to
    split 0, the next ones to split 1, ... No row is in two splits."""
    top = hash_sample(df, key, sum(sizes.values()))
    ranked = placed(top, hash_rank_key(key), "splits", "rank").withColumn("rank", (F.col("rank") + 1).cast("long"))
    split = None
    upper = 0
    for name, size in sizes.items():
        upper += size
        cond = F.col("rank") <= upper
        split = F.when(cond, F.lit(name)) if split is None else split.when(cond, F.lit(name))
    return ranked.withColumn("split", split)


def surrogate_ids(df: DataFrame, order_col: str, id_col: str = "surrogate_id",
                  partitions: int | None = None) -> DataFrame:
    """Dense 1-based ids in ``order_col`` order without a single-task window.

    1. range-partition by the order column (sampled bounds), tag rows with
       their partition id and checkpoint, so that the assignment is fixed;
    2. count rows per partition -> cumulative offsets (one row per
       partition: bounded by the partition count, safe to broadcast);
    3. id = offset of the partition + row number inside the partition.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n = partitions or sized_partitions(df)
    tagged = (df.repartitionByRange(n, F.col(order_col))
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(order_col))
    return (tagged.withColumn("_local", local)
            .join(F.broadcast(offsets), "_pid")
            .withColumn(id_col, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_pid", "_local", "_off"))
