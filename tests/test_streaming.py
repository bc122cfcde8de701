"""Stream ingest: drain, crash after a write, restart, exact result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.streaming import ingest

MSG = ("event_id bigint, ticket_id bigint, customer_id bigint, customer_name string, event_type string, "
       "latency_ms int, event_time timestamp_ntz, _ingested_at timestamp_ntz")


def messages(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, i % 7, i % 3, f"C{i % 3}", "view", i, t0, t0 + dt.timedelta(seconds=i)) for i in range(300)]
    # re-deliveries with corrected latency, later
    rows += [(i, i % 7, i % 3, f"C{i % 3}", "view", i + 1000, t0, t0 + dt.timedelta(seconds=1000 + i))
             for i in range(0, 300, 10)]
    return spark.createDataFrame(rows, MSG)


class Crash(RuntimeError):
    pass


def sink(spark, root, keep="last", guarded=True):
    return ingest.stream_table(spark, root, keep=keep, guarded=guarded)


def test_crash_and_restart_gives_exact_table(spark, scratch):
    log, ckpt = scratch("log"), scratch("ckpt")
    ingest.publish_log(messages(spark), log, 10, ["_ingested_at", "event_id"])
    schema = spark.read.parquet(log).schema
    table = sink(spark, scratch("sink"))

    def crash(batch_id):
        if batch_id == 2:
            raise Crash("after the write, before the stream's commit")

    with pytest.raises(Exception, match="after the write"):
        ingest.consume(spark, log, schema, table, ckpt, after_batch=crash)
    second = ingest.consume(spark, log, schema, table, ckpt)
    assert second[0]["batch"] == 2  # the crashed batch is replayed
    got = {r["event_id"]: r["latency_ms"] for r in table.read().collect()}
    assert len(got) == 300 and table.read().count() == 300
    assert all(got[i] == (i + 1000 if i % 10 == 0 else i) for i in range(300))


def test_first_wins_keeps_original(spark, scratch):
    log = scratch("log1")
    ingest.publish_log(messages(spark), log, 6, ["_ingested_at", "event_id"])
    schema = spark.read.parquet(log).schema
    table = sink(spark, scratch("sink1"), "first")
    ingest.consume(spark, log, schema, table, scratch("ckpt1"), max_files_per_batch=4)
    got = {r["event_id"]: r["latency_ms"] for r in table.read().collect()}
    assert got == {i: i for i in range(300)}


def test_very_late_row_is_kept_and_marked(spark, scratch):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, 0, 0, "C", "view", 1, t0 + dt.timedelta(days=i), t0 + dt.timedelta(days=i, hours=1)) for i in range(20)]
    rows.append((99, 0, 0, "C", "view", 1, t0, t0 + dt.timedelta(days=20)))
    log = scratch("late")
    ingest.publish_log(spark.createDataFrame(rows, MSG), log, 4, ["_ingested_at", "event_id"])
    table = sink(spark, scratch("sink2"), "first")
    ingest.dedup_arrivals(spark, log, spark.read.parquet(log).schema, table, scratch("ckpt2"), "event_time",
                          "_ingested_at", 3, ["event_id", "event_time", "_ingested_at"], max_files_per_batch=1)
    got = {r["event_id"]: r["late"] for r in table.read().collect()}
    assert len(got) == 21 and got[99] and sum(got.values()) == 1


def test_unconditional_upsert_stores_the_message_consumed_last(spark, scratch):
    log = scratch("log3")
    ingest.publish_log(messages(spark), log, 6, ["_ingested_at", "event_id"])
    schema = spark.read.parquet(log).schema
    table = sink(spark, scratch("sink3"), guarded=False)
    ingest.consume(spark, log, schema, table, scratch("ckpt3"))
    # a second consumer group reads only the oldest messages again: consumed last, so they are stored
    first = scratch("log4")
    ingest.publish_log(messages(spark).where("latency_ms < 50"), first, 1, ["_ingested_at", "event_id"])
    ingest.consume(spark, first, schema, table, scratch("ckpt4"))
    got = {r["event_id"]: r["latency_ms"] for r in table.read().collect()}
    assert len(got) == 300 and got[10] == 10 and got[100] == 1100


def test_batches_are_bounded_by_bytes(spark, scratch):
    """Small segments share a batch up to the byte bound; a segment larger than the bound is a batch of its own."""
    import glob
    import os
    log = scratch("bytes")
    rows = messages(spark)
    small = rows.where("event_id < 100")
    ingest.publish_log(small, log, 6, ["_ingested_at", "event_id"])
    sizes = [os.path.getsize(f) for f in glob.glob(f"{log}/*.parquet")]
    fat = rows.where("event_id >= 100").withColumn("customer_name", F.expr("repeat(md5(cast(event_id as string)), 200)"))
    fat.coalesce(1).write.mode("append").parquet(log)
    bound = 3 * max(sizes) + 1
    assert max(os.path.getsize(f) for f in glob.glob(f"{log}/*.parquet")) > bound
    table = sink(spark, scratch("bytes-sink"))
    got = ingest.consume(spark, log, rows.schema, table, scratch("bytes-ckpt"), max_bytes_per_batch=bound)
    big = fat.count()
    assert len(got) >= 3 and sorted(b["rows"] for b in got)[-1] >= big and sum(b["rows"] for b in got) == rows.count()
    assert all(b["rows"] <= small.count() for b in got[:-1]) and table.read().count() == 300


@pytest.mark.parametrize("dies", [None, 1, 3])
def test_state_store_dedup_loses_no_row(spark, scratch, dies):
    """Timely repeats, repeats behind the watermark, rows late from the start; also over a crash and a restart."""
    t0 = dt.datetime(2024, 1, 1)
    day = lambda n: t0 + dt.timedelta(days=n)
    rows = [(i, 0, 0, "C", "view", 1, day(i), day(i + 0.1)) for i in range(30)]
    rows += [(i, 0, 0, "C", "view", 2, day(i), day(i + 1)) for i in range(0, 30, 3)]  # again in time
    rows += [(i, 0, 0, "C", "view", 3, day(i), day(i + 9)) for i in range(0, 20, 4)]  # again, long after
    rows += [(100 + i, 0, 0, "C", "view", 4, day(i), day(i + 5 + k)) for i in range(4) for k in (0, 3)]  # only late, twice
    log, root, ckpt = scratch("statelog"), scratch("state"), scratch("stateckpt")
    ingest.publish_log(spark.createDataFrame(rows, MSG), log, 8, ["_ingested_at", "event_id"])

    def run(after=None):
        ingest.dedup_in_state(spark, log, spark.read.parquet(log).schema, root, ckpt, "event_id", "event_time", "_ingested_at", 2,
                              ["event_id", "latency_ms", "event_time", "_ingested_at"], 1, after)

    if dies is not None:
        def crash(batch_id):
            if batch_id == dies:
                raise Crash("after the write")
        with pytest.raises(Exception, match="after the write"):
            run(crash)
    run()
    got = {r["event_id"]: (r["latency_ms"], r["late"]) for r in ingest.deduplicated(spark, root, "event_id", "_ingested_at").collect()}
    assert got == {**{i: (1, False) for i in range(30)}, **{100 + i: (4, True) for i in range(4)}}
    assert ingest.deduplicated(spark, root, "event_id", "_ingested_at").count() == 34
