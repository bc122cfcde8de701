"""File sources, JSON projection, compaction and scan metrics, lookback anchor."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.operators import lateness
from stratum.plans import layout
from stratum.sources import files


def test_jsonl_declared_schema_fails_fast_on_bad_record(spark, scratch):
    path = scratch("jsonl")
    spark.createDataFrame([('{"a": 1, "t": "2024-01-01 00:00:00.000000"}',),
                           ('{"a": "x", "t": "2024-01-01 00:00:00.000000"}',)], "value string") \
        .coalesce(1).write.text(path)
    df = files.read_jsonl(spark, path, "a int, t timestamp_ntz")
    with pytest.raises(Exception):
        df.collect()


def test_jsonl_round_trip_keeps_microseconds(spark, scratch):
    path = scratch("rt")
    t = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    src = spark.createDataFrame([(1, t)], "id bigint, ts timestamp_ntz")
    files.export_jsonl(src, path)
    assert files.read_jsonl(spark, path, src.schema).collect()[0]["ts"] == t


def test_json_projection_keeps_scalars_as_text(spark):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, '{"k": "high"}'), (3, '{"k": null}'), (4, '{}')],
                               "id bigint, props string")
    got = {r["id"]: r["k"] for r in files.project_json(df, "props", "k STRING").collect()}
    assert got == {1: "3", 2: "high", 3: None, 4: None}


def test_compaction_prunes_and_keeps_rows(spark, scratch):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, f"C{i % 7}", base + dt.timedelta(hours=i)) for i in range(24 * 10)]
    df = spark.createDataFrame(rows, "event_id bigint, customer_name string, event_time timestamp_ntz") \
        .withColumn("event_date", F.to_date("event_time"))
    path = scratch("compact")
    rep = layout.compact(df, path, "event_date", ["customer_name", "event_time"], partitions=4)
    assert rep["rows_before"] == rep["rows_after"] == 240

    def lookup(d):
        return d.where((F.col("event_date") == F.lit(dt.date(2024, 1, 3))) & (F.col("customer_name") == "C1")) \
                .agg(F.count(F.lit(1)).alias("n"))

    r = layout.scan_report(spark, "after", path, lookup)
    assert r["result_rows"] == 1 and r["files_read"] < r["files_on_disk"]
    assert r["rows_scanned"] <= 24


def test_lookback_anchor_and_cap():
    assert lateness.lookback_start(None, 3) is None
    assert lateness.lookback_start(dt.date(2024, 1, 10), 3) == dt.date(2024, 1, 7)
    # one far-future day must not freeze the window when capped
    assert lateness.lookback_start(dt.date(2030, 1, 1), 3, cap=dt.date(2024, 1, 10)) == dt.date(2024, 1, 7)
