"""Restart-safe stream ingest: file log -> Structured Streaming -> keyed upsert.

* Source: a folder the producer appends files to (the topic). The
  stream's checkpoint holds which files were consumed (the per-group
  offsets); one checkpoint folder = one consumer group.
* Pull until drained: ``trigger(availableNow=True)`` processes everything
  present at start in bounded micro-batches (``maxFilesPerTrigger``, or
  ``maxBytesPerTrigger``), then stops.
* At-least-once made exact: Spark logs a batch's offsets before running it
  and marks it committed only after ``foreachBatch`` returns. A batch is one slice
  of the table, named by consumer group and batch number. A crash after
  the sink write but before that commit replays the batch on restart, which
  replaces its own slice by the same rows.

On a cluster the same code reads Kafka (``format("kafka")`` with
``maxOffsetsPerTrigger``); only the source lines change.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stratum.functions.timefn import add_seconds
from stratum.plans import storage
from stratum.sources.files import TS_FORMAT
from stratum.plans import writers as W

# Columns of the stream sink table (one row per event id).
STREAM_COLUMNS = ["event_id", "ticket_id", "customer_id", "customer_name", "event_type",
                  "latency_ms", "event_time", "_ingested_at"]


def publish_log(messages: DataFrame, path: str, files: int, order: Sequence[str], fmt: str = "parquet") -> int:
    """Write messages as ``files`` Parquet segments, contiguous in ``order``
    (range partitioned), the way a producer appends segments to a topic.

    The file source consumes files by modification time; the segments are
    written in parallel, so their times are set afterwards in segment order
    to match the order a producer would have appended them in.
    """
    import time

    keyed = [F.col(c) for c in order]
    segments = messages.repartitionByRange(files, *keyed).sortWithinPartitions(*keyed)
    if fmt == "json":  # JSON lines, timestamps as formatted text
        segments = segments.select(*[F.date_format(F.col(f.name), TS_FORMAT).alias(f.name)
                                     if f.dataType.typeName() in ("timestamp", "timestamp_ntz") else F.col(f.name)
                                     for f in messages.schema.fields])
        segments.write.mode("overwrite").json(path)
        suffix = ".json"
    else:
        segments.write.mode("overwrite").parquet(path)
        suffix = ".parquet"
    spark = messages.sparkSession
    return storage.set_mtimes_in_name_order(spark, path, suffix, int(time.time() * 1000) - 3_600_000)


def _source(spark: SparkSession, log_path: str, schema: StructType, max_files: int, fmt: str,
            max_bytes: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    # Spark takes one of the two bounds; a file larger than the byte bound is a batch of its own
    reader = reader.option("maxBytesPerTrigger", max_bytes) if max_bytes else reader.option("maxFilesPerTrigger", max_files)
    if fmt == "json":  # a JSONL topic: declared schema, strict parsing
        return (reader.option("mode", "FAILFAST").option("timestampNTZFormat", TS_FORMAT)
                .option("timestampFormat", TS_FORMAT).json(log_path))
    return reader.parquet(log_path)


CONSUMED = "_consumed"


def stream_table(spark: SparkSession, root: str, key: str = "event_id", order: Sequence[str] = ("_ingested_at",),
                 keep: str = "last", guarded: bool = True) -> W.SlicedTable:
    """The sink of ``consume``. ``keep="last"``: a re-delivered message with changed content replaces the stored one
    (latest ``order`` wins); ``"first"``: the first delivery is kept. Both go by ``order``, so neither depends on the
    order in which batches arrive. ``guarded=False`` is the unconditional ``DO UPDATE``: the message consumed last wins."""
    return W.SlicedTable(spark, root, key, list(order) if guarded else [CONSUMED, *order], keep)


def _drain(stream: DataFrame, table: W.SlicedTable, checkpoint: str, shape: Callable[[DataFrame], DataFrame],
           after_batch: Callable[[int], None] | None = None, collapsed: bool = False) -> list[dict]:
    group = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch)
        if CONSUMED in table.order:
            rows = rows.withColumn(CONSUMED, F.current_timestamp())
        table.put(f"{group}-{batch_id:08d}", rows, collapsed)
        if after_batch is not None:
            after_batch(batch_id)

    query = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return [{"batch": p["batchId"], "rows": p["numInputRows"]} for p in query.recentProgress if p["numInputRows"] > 0]


def consume(spark: SparkSession, log_path: str, schema: StructType, table: W.SlicedTable, checkpoint: str,
            max_files_per_batch: int = 2, columns: Sequence[str] = STREAM_COLUMNS, fmt: str = "parquet",
            max_bytes_per_batch: int | None = None, after_batch: Callable[[int], None] | None = None) -> list[dict]:
    """Drain the log into ``table``, one slice per batch. ``after_batch`` is called when a batch is in the table
    and not yet committed by the stream. Returns number and rows of the batches processed."""
    stream = _source(spark, log_path, schema, max_files_per_batch, fmt, max_bytes_per_batch)
    return _drain(stream, table, checkpoint, lambda batch: batch.select(*columns), after_batch)


def dedup_arrivals(spark: SparkSession, log_path: str, schema: StructType, table: W.SlicedTable, checkpoint: str,
                   event_time: str, arrived: str, delay_days: int, columns: Sequence[str],
                   max_files_per_batch: int = 2) -> list[dict]:
    """Streaming twin of first-arrival de-duplication that loses no late row.

    ``table`` keeps the first delivery of a key whatever its delay, so no watermark
    drops a row behind it. Rows that arrived more than ``delay_days`` after their event
    time are marked ``late`` instead, to be counted or routed by the reader.
    """
    late = F.col(arrived) > add_seconds(F.col(event_time), delay_days * 86400)
    stream = _source(spark, log_path, schema, max_files_per_batch, "parquet")
    return _drain(stream, table, checkpoint, lambda batch: batch.select(*columns, late.alias("late")))


def dedup_in_state(spark: SparkSession, log_path: str, schema: StructType, root: str, checkpoint: str, key: str,
                   event_time: str, arrived: str, delay_days: int, columns: Sequence[str],
                   max_files_per_batch: int = 2, after_batch: Callable[[int], None] | None = None) -> None:
    """First deliveries by the state store: append-only, nothing stored is read or written again.

    Rows that arrived within ``delay_days`` of their event time go through ``dropDuplicatesWithinWatermark``: a key's state
    expires once the watermark has passed it, so the state is bounded by the keys of that time span, not by the table. No such
    row is behind the watermark: what was read before it had arrived by then. The other rows are late; they go to
    a side output, ``root``/late, one row per key. ``deduplicated`` puts both together. Which of several timely deliveries
    in one micro-batch is kept is not defined.
    """
    late = F.col(arrived) > add_seconds(F.col(event_time), delay_days * 86400)
    side = W.SlicedTable(spark, f"{root}/late", key, [arrived], "first")
    # without duplicates already; a batch that is replayed after a crash replaces its own slice
    timely = W.SlicedTable(spark, f"{root}/timely", key, [arrived], "first")

    def stream() -> DataFrame:
        return _source(spark, log_path, schema, max_files_per_batch, "parquet")

    rows = stream().where(~late).withColumn("_et", F.col(event_time).cast("timestamp"))
    once = rows.withWatermark("_et", f"{delay_days} days").dropDuplicatesWithinWatermark([key])
    _drain(once, timely, f"{checkpoint}/timely", lambda b: b.select(*columns), after_batch, collapsed=True)
    _drain(stream().where(late), side, f"{checkpoint}/late", lambda b: b.select(*columns), after_batch)


def deduplicated(spark: SparkSession, root: str, key: str, arrived: str) -> DataFrame:
    """The first delivery of every key that ``dedup_in_state`` wrote under ``root``, with ``late``."""
    timely = W.SlicedTable(spark, f"{root}/timely", key, [arrived], "first").slices()
    late = W.SlicedTable(spark, f"{root}/late", key, [arrived], "first").read()
    parts = []
    if timely is not None:
        parts.append(timely.drop(W.SLICE).withColumn("late", F.lit(False)))
    if late is not None:
        rest = late if timely is None else W.null_safe(late, timely.select(key), [key], "left_anti")
        parts.append(rest.withColumn("late", F.lit(True)))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
