"""Histogram sort into shards of near equal bytes.

Rows are ordered by a 62-bit key: 40 bits of a hash of (id, text), then 22 bits of a
hash of the row's number, which is given once, in a written table. Splitters are found by
probing: each round counts the exact bytes and rows between evenly spaced
candidate boundaries inside the interval that still holds a splitter, on all
partitions, and goes on inside the bucket that the target falls into, until
the bytes below are within the tolerance or the interval is one key. Then
every row is exchanged once, to its shard and a sub-range of it, and numbered.

The law is ``bytes``: shards of near equal sizes. Equal texts are not kept in one
shard (a group of copies may be larger than one): the row's number tells repeated
rows apart, so that they can be split like any others.

Scale: the probes read narrow columns (key, size) of the written table; a round brings
at most (shards - 1) * probes sums to the driver. Slots are numbered within
sub-ranges, whose number follows the counted rows and bytes, and shifted by the counts of
the sub-ranges before them, so no task sorts a whole shard; the exchange has a
partition per ``task_bytes`` of the counted bytes, and many sub-ranges in each, so a task's
share doesn't grow with the data.

Defined cases: null text has size 1 and checksum of no bytes. A null id hashes like no
id. An empty table gives no rows; more shards than rows leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from stratum.operators.ordering import numbered_rows, written

KEY_BITS, ROW_BITS = 62, 22


def _key(id_col: str, text_col: str, row: Column) -> Column:
    content = F.shiftrightunsigned(F.xxhash64(id_col, text_col), 64 - KEY_BITS + ROW_BITS)
    return F.shiftleft(content, ROW_BITS) + F.shiftrightunsigned(F.xxhash64(F.lit(3), row), 64 - ROW_BITS)


def row_size(text_col: str) -> Column:
    return (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long")


def splitters(keys: DataFrame, shards: int, tolerance: float = 1e-4, probes: int = 64) -> list[int]:
    """Ascending keys: shard i holds the keys of [splitter i-1, splitter i).
    ``keys`` has columns key and size; ``tolerance`` is a share of a shard's bytes."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    # target -> (interval low, high, bytes below low)
    open_ = {k: (0, 1 << KEY_BITS, 0) for k in range(1, shards)}
    done: dict[int, int] = {}
    while open_:
        ranges = sorted({(lo, hi) for lo, hi, _ in open_.values()})
        step = {r: -(-(r[1] - r[0]) // probes) for r in ranges}
        cell = F.lit(None).cast("struct<r:int,b:bigint>")
        for i, (lo, hi) in enumerate(ranges):
            inside = (F.col("key") >= lo) & (F.col("key") < hi)
            bucket = F.expr(f"(key - {lo}L) div {step[lo, hi]}L")
            cell = F.when(inside, F.struct(F.lit(i).alias("r"), bucket.alias("b"))).otherwise(cell)
        sums = keys.select(cell.alias("c"), "size").where("c is not null").groupBy("c").agg(F.sum("size").alias("s")).collect()
        bytes_in = {(x["c"]["r"], x["c"]["b"]): x["s"] for x in sums}
        for k, (lo, hi, below) in list(open_.items()):
            r, w, goal = ranges.index((lo, hi)), step[lo, hi], total * k / shards
            for b in range(-(-(hi - lo) // w)):
                here = bytes_in.get((r, b), 0)
                if below + here >= goal or b == -(-(hi - lo) // w) - 1:
                    break
                below += here
            at, end = lo + b * w, min(hi, lo + (b + 1) * w)
            if goal - below <= slack or end - at <= 1:
                # of a last single key, the boundary before or after it is nearer to the target
                done[k] = at if goal - below <= max(slack, below + here - goal) else end
                del open_[k]
            elif below + here - goal <= slack:
                done[k] = end
                del open_[k]
            else:
                open_[k] = (at, end, below)
    return [done[k] for k in range(1, shards)]


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                    tolerance: float = 1e-4, rows_per_range: int = 50_000, task_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` with its columns, plus ``_size``, ``_shard`` and ``_slot`` (gapless from 0 in the shard)."""
    rows = numbered_rows(docs, "shard-rows").withColumn("_size", row_size(text_col))
    rows = rows.withColumn("_key", _key(id_col, text_col, F.col("_row"))).drop("_row")
    keys = written(rows.select(F.col("_key").alias("key"), F.col("_size").alias("size")), "shard-keys")
    cuts = splitters(keys, shards, tolerance)
    n, size = keys.agg(F.count(F.lit(1)), F.sum("size")).first()
    # many small ranges a task: the hash that deals them evens out
    ranges = max(1, -(-n // rows_per_range), -(-(size or 0) // (task_bytes // 16)))
    width = -(-(1 << KEY_BITS) // ranges)

    def place(df: DataFrame, key: str) -> DataFrame:
        shard = F.lit(0)
        for c in cuts:
            shard = shard + F.when(F.col(key) >= F.lit(c), 1).otherwise(0)
        return df.withColumn("_shard", shard).withColumn("_range", F.expr(f"{key} div {width}L"))

    counts = place(keys, "key").groupBy("_shard", "_range").agg(F.count(F.lit(1)).alias("_n"))
    # one row per range: few, whatever the rows
    before = F.sum("_n").over(Window.partitionBy("_shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    start = counts.select(F.col("_shard").alias("_s"), F.col("_range").alias("_r"),
                          F.coalesce(before, F.lit(0)).alias("_start"))
    # as many partitions as the counted bytes and rows ask for, not as the session has
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-(size or 0) // task_bytes), -(-n // (16 * rows_per_range)))
    dealt = place(rows, "_key").repartition(tasks, "_shard", "_range")
    within = F.row_number().over(Window.partitionBy("_shard", "_range").orderBy("_key", id_col)) - 1
    return (dealt.withColumn("_in", within)
                .join(start, (F.col("_shard") == F.col("_s")) & (F.col("_range") == F.col("_r")))
                .withColumn("_slot", (F.col("_start") + F.col("_in")).cast("long"))
                .drop("_key", "_range", "_in", "_s", "_r", "_start"))


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    sharded.sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(folder)

