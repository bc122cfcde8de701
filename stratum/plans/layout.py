"""Storage layout: compaction with partition pruning, and scan-effort reports.

``compact`` rewrites a dataset Hive-partitioned by a day column, rows sorted
by the lookup column inside each file and small row groups, so that a
two-column point lookup reads one day folder and, inside it, only the row
groups whose min/max cover the key. The row count is checked before and
after (a lossless rewrite or an error).

``scan_report`` runs a query and reads the scan metrics of its executed
plan (files and rows the Parquet scans produced), next to the result hash,
so that two layouts can be compared on effort and on result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
import pyarrow.fs as pafs
import pyarrow.parquet as pq

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from stratum.session import sized_partitions


class LossyRewriteError(RuntimeError):
    """A rewrite changed the number of rows."""


# --- fixed values: target row-group size of the compacted layout ---
ROW_GROUP_ROWS = 2048
# Pages inside a row group carry min/max in the page index, so a pushed
# filter can skip pages of a matching row group too.
PAGE_ROWS = 256


def compact(df: DataFrame, path: str, partition_col: str, sort_cols: Sequence[str],
            partitions: int | None = None, row_group_rows: int = ROW_GROUP_ROWS, bloom_cols: Sequence[str] = ()) -> dict:
    """Range-partition on (day, sort columns), sort inside each task and
    write one folder per day.

    Range partitioning keeps each task on a contiguous slice of the sort
    order: a small day ends up in one file, a big (or skewed) day is split
    over several tasks by the sampled range bounds instead of landing in a
    single task. ``bloom_cols`` get a Bloom filter per row group, so that a lookup of a value that no row has skips
    row groups whose min/max cover it. Returns rows before/after and files written.
    """
    spark = df.sparkSession
    n = partitions or sized_partitions(df)
    obs = Observation()
    keyed = [F.col(partition_col), *[F.col(c) for c in sort_cols]]
    # Observe after the range exchange: its bound-sampling job re-runs the
    # plan below it, which would count those rows twice.
    out = (df.repartitionByRange(n, *keyed)
           .sortWithinPartitions(*keyed)
           .observe(obs, F.count(F.lit(1)).alias("rows")))
    writer = (out.write.mode("overwrite")
                 .option("parquet.block.row.count.limit", row_group_rows)
                 .option("parquet.page.row.count.limit", PAGE_ROWS))
    for c in bloom_cols:
        writer = (writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
                        .option(f"parquet.bloom.filter.expected.ndv#{c}", str(row_group_rows)))
    writer.partitionBy(partition_col).parquet(path)
    before = int(obs.get["rows"])
    back = spark.read.parquet(path)
    after = back.count()
    if after != before:
        raise LossyRewriteError(f"compaction changed the row count: {before} -> {after}")
    return {"rows_before": before, "rows_after": after, "files": len(back.inputFiles())}


# --- zone maps ----------------------------------------------------------------------

def _footers(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Per file path: one row per row group and column, from the footer alone."""
    for pdf in batches:
        rows = []
        for uri in pdf["path"]:
            fs, name = (pafs.LocalFileSystem(), re.sub("^file:/+", "/", uri)) if uri.startswith("file:") else pafs.FileSystem.from_uri(uri)
            with fs.open_input_file(unquote(name)) as f:
                meta = pq.ParquetFile(f).metadata
            at = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                for c in columns:
                    s = group.column(at[c]).statistics
                    known = s is not None and s.has_min_max
                    rows.append((uri, g, group.num_rows, c, str(s.min) if known else None, str(s.max) if known else None))
        yield pd.DataFrame(rows, columns=["file", "row_group", "rows", "column_name", "low", "high"])


def zone_map(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """(file, row_group, rows, column_name, low, high) of every row group of the Parquet files under ``path``: Spark lists the
    files, tasks read their footers. Text columns: bounds are compared as text."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
              .load(path).select("path"))
    names = list(columns)
    return listed.mapInPandas(lambda b: _footers(b, names),
                              "file string, row_group int, rows bigint, column_name string, low string, high string")


def predicted(zones: DataFrame, equals: dict[str, str], partitions: dict[str, str] | None = None) -> DataFrame:
    """(file, row_group, rows) that a reader can't skip by min/max for ``column = value`` (one row per row group), in the
    ``partitions`` folders."""
    for col, value in (partitions or {}).items():
        zones = zones.where(F.contains("file", F.lit(f"/{col}={value}/")))
    skip = F.lit(False)
    for col, value in equals.items():
        skip = skip | ((F.col("column_name") == col) & ((F.lit(value) < F.col("low")) | (F.lit(value) > F.col("high"))))
    return (zones.groupBy("file", "row_group", "rows").agg(F.bool_or(F.coalesce(skip, F.lit(False))).alias("skip"))
                 .where("not skip").drop("skip"))


# --- scan metrics ------------------------------------------------------------------

def _children(node) -> list:
    """Children of a physical plan node, looking through adaptive wrappers."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return [node.executedPlan()]
    if name.endswith("QueryStageExec"):
        return [node.plan()]
    if name == "ReusedExchangeExec":
        return [node.child()]
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def _metric(node, key: str) -> int | None:
    m = node.metrics().get(key)
    return int(m.get().value()) if m.isDefined() else None


def scan_metrics(df: DataFrame) -> dict:
    """Files and rows read by the Parquet scans of ``df``'s last execution."""
    plan = df._jdf.queryExecution().executedPlan()
    files = rows = scans = 0
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            scans += 1
            files += _metric(node, "numFiles") or 0
            rows += _metric(node, "numOutputRows") or 0
        stack.extend(_children(node))
    return {"scans": scans, "files_read": files, "rows_scanned": rows}


def result_hash(rows: list) -> str:
    """Order-free hash of a (small) query result."""
    text = sorted(json.dumps([str(v) for v in r], ensure_ascii=False) for r in rows)
    return hashlib.md5("\n".join(text).encode()).hexdigest()[:12]


def scan_report(spark: SparkSession, label: str, dataset_path: str,
                query: Callable[[DataFrame], DataFrame]) -> dict:
    """Run ``query`` on the dataset; report effort, size on disk, result.

    Parquet row-group skipping happens inside the reader, so
    ``rows_scanned`` is what the scan handed on after pruning folders,
    files and row groups.
    """
    data = spark.read.parquet(dataset_path)
    result = query(data)
    rows = result.collect()
    m = scan_metrics(result)
    return {"layout": label, "path": dataset_path, **m, "files_on_disk": len(data.inputFiles()),
            "rows_on_disk": data.count(), "result_rows": len(rows), "result_hash": result_hash(rows)}


def accept(before: dict, after: dict, min_reduction: float = 10.0) -> dict:
    """Acceptance of a layout change: same result, fewer files read, and at
    least ``min_reduction`` times fewer rows scanned."""
    reduction = before["rows_scanned"] / max(after["rows_scanned"], 1)
    return {"reduction": round(reduction, 1),
            "same_result": before["result_hash"] == after["result_hash"],
            "fewer_files": after["files_read"] < before["files_read"],
            "ok": (before["result_hash"] == after["result_hash"] and reduction >= min_reduction
                   and after["files_read"] < before["files_read"])}
