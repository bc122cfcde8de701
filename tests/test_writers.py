"""Write strategies: idempotence, guards, order independence, crash safety."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.plans import jobs, writers as W

SCHEMA = "event_id bigint, latency_ms int, _ingested_at timestamp_ntz"


def ts(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def rows(table):
    return sorted(tuple(r) for r in table.read().collect())


def table(spark, root, keep="last", order=("_ingested_at",)):
    return W.SlicedTable(spark, root, "event_id", list(order), keep)


def test_merge_is_idempotent_and_never_deletes(spark, scratch):
    tbl = table(spark, scratch("merge"), order=[W.SLICE])  # the last batch wins
    a = spark.createDataFrame([(1, 10, ts(0)), (2, 20, ts(5))], SCHEMA)
    b = spark.createDataFrame([(2, 21, ts(1)), (3, 30, ts(1))], SCHEMA)
    tbl.put("0", a)
    tbl.put("1", b)
    once = rows(tbl)
    tbl.put("1", b)
    assert rows(tbl) == once == [(1, 10, ts(0)), (2, 21, ts(1)), (3, 30, ts(1))]
    merged = W.merged(a, b, ["event_id"])
    assert sorted(tuple(r) for r in merged.collect()) == once
    live = spark.createDataFrame([(2,), (3,)], "event_id bigint")
    assert sorted(r[0] for r in W.merged(a, b, ["event_id"], keep_only=live).collect()) == [2, 3]


@pytest.mark.parametrize("write", ["put", "replace_partitions", "replace_slice"])
@pytest.mark.parametrize("change", ["added", "missing", "retyped"])
def test_schema_drift_is_refused_on_every_path(spark, scratch, write, change):
    base = spark.createDataFrame([(1, 10, ts(0))], SCHEMA).withColumn("d", F.lit("x"))
    drift = {"added": base.withColumn("extra", F.lit(1)), "missing": base.drop("latency_ms"),
             "retyped": base.withColumn("latency_ms", F.col("latency_ms").cast("string"))}[change]
    root = scratch("drift")
    tbl = table(spark, root)
    do = {"put": lambda df: tbl.put("a", df),
          "replace_partitions": lambda df: W.replace_partitions(df, root, ["d"]),
          "replace_slice": lambda df: W.replace_slice(df, root, "slice", "a")}[write]
    do(base)
    with pytest.raises(W.SchemaDriftError):
        do(drift)


def test_merge_source_must_be_unique(spark, scratch):
    with pytest.raises(W.DuplicateKeyError):
        W.check_unique(spark.createDataFrame([(2, 1, ts(0)), (2, 2, ts(0))], SCHEMA), ["event_id"])


def test_append_is_not_idempotent(spark, scratch):
    path = scratch("append")
    df = spark.createDataFrame([(1, 10, ts(0))], SCHEMA)
    W.append(df, path)
    W.append(df, path)
    assert spark.read.parquet(path).count() == 2


def test_partition_replace_replays_cleanly(spark, scratch):
    path = scratch("parts")
    df = spark.createDataFrame([(1, 10, ts(0)), (2, 20, ts(30))], SCHEMA).withColumn("d", F.to_date("_ingested_at"))
    for _ in range(3):
        W.replace_partitions(df, path, ["d"])
    assert spark.read.parquet(path).count() == 2
    # replacing one day leaves the other alone
    W.replace_partitions(df.where(F.col("event_id") == 1).withColumn("latency_ms", F.lit(99)), path, ["d"])
    got = sorted((r["event_id"], r["latency_ms"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, 99), (2, 20)]


def test_empty_slice_replaces_stale_rows(spark, scratch):
    path = scratch("slice")
    df = spark.createDataFrame([(1, 10, ts(0))], SCHEMA)
    W.replace_slice(df, path, "slice", "a")
    W.replace_slice(df, path, "slice", "b")
    W.replace_slice(df.limit(0), path, "slice", "a")
    assert [r["slice"] for r in spark.read.parquet(path).collect()] == ["b"]


def test_null_partition_value_keeps_all_rows(spark, scratch):
    path = scratch("nullday")
    df = spark.createDataFrame([(1, 10, None), (2, 20, ts(0))], SCHEMA).withColumn("d", F.to_date("_ingested_at"))
    W.replace_slice(df, path, "slice", "a", inner=["d"])
    W.replace_slice(df.where("event_id = 1").withColumn("event_id", F.lit(3).cast("long")), path, "slice", "b", inner=["d"])
    assert sorted(r["event_id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_upsert_result_does_not_depend_on_batch_order(spark, scratch):
    b1 = spark.createDataFrame([(1, 10, ts(0)), (1, 11, ts(5)), (2, 20, ts(1))], SCHEMA)
    b2 = spark.createDataFrame([(1, 12, ts(3)), (2, 21, ts(9))], SCHEMA)
    results = {}
    for keep in ("last", "first"):
        outs = []
        for order in ((b1, b2), (b2, b1), (b1, b2, b1)):
            tbl = table(spark, scratch(f"ups-{keep}"), keep)
            for i, b in enumerate(order):
                tbl.put(str(i), b)
            outs.append(rows(tbl))
        assert outs[0] == outs[1] == outs[2]
        results[keep] = outs[0]
    assert results["last"] == [(1, 11, ts(5)), (2, 21, ts(9))]
    assert results["first"] == [(1, 10, ts(0)), (2, 20, ts(1))]


@pytest.mark.parametrize("keep", ["last", "first"])
def test_slices_read_like_upserts_one_after_the_other(spark, scratch, keep):
    batches = [[(1, 10, ts(0)), (1, 11, ts(5)), (None, 7, ts(1))], [(1, 12, ts(3)), (2, 21, ts(9)), (None, 8, ts(0))], []]
    tbl, plain, first = table(spark, scratch("same"), keep), None, None
    for i, b in enumerate(spark.createDataFrame(x, SCHEMA) for x in batches):
        tbl.put(str(i), b)
        plain = W.upserted(plain, b, "event_id", ["_ingested_at"], keep)
        first = W.inserted(first, b, "event_id", ["_ingested_at"])
    assert sorted(map(repr, rows_of(tbl.read()))) == sorted(map(repr, rows_of(plain)))
    assert {r[0]: r[1] for r in rows_of(first)} == {1: 10, None: 7, 2: 21}


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_unguarded_upsert_takes_incoming(spark):
    old = spark.createDataFrame([(1, 10, ts(5))], SCHEMA)
    new = spark.createDataFrame([(1, 11, ts(1))], SCHEMA)
    assert rows_of(W.upserted(old, new, "event_id", ["_ingested_at"], guarded=False)) == [(1, 11, ts(1))]


def test_null_key_is_one_key(spark, scratch):
    df = spark.createDataFrame([(None, 10, ts(0)), (1, 1, ts(0))], SCHEMA)
    tbl = table(spark, scratch("nullkey"))
    for i in range(3):
        tbl.put(str(i), df)
    assert tbl.read().count() == 2


def test_a_write_leaves_other_slices_alone(spark, scratch):
    root = scratch("touch")
    tbl = table(spark, root)
    tbl.put("a", spark.createDataFrame([(i, i, ts(0)) for i in range(1000)], SCHEMA))
    before = set(spark.read.parquet(f"{root}/_slice=a").inputFiles())
    assert tbl.put("b", spark.createDataFrame([(7, 70, ts(1))], SCHEMA)) == 1
    assert set(spark.read.parquet(f"{root}/_slice=a").inputFiles()) == before
    assert tbl.read().count() == 1000 and tbl.read(until="a").where("event_id = 7").first()["latency_ms"] == 7


@pytest.mark.parametrize("dies", [None, "delete"])
def test_folding_old_slices_changes_no_row(spark, scratch, monkeypatch, dies):
    from stratum.plans import storage
    tbl = table(spark, scratch("fold"))
    for i in range(5):
        tbl.put(f"c-{i}", spark.createDataFrame([(k, 10 * i + k, ts(i - k)) for k in range(4)], SCHEMA))
    want = rows(tbl)
    if dies:
        real = storage.delete
        monkeypatch.setattr(storage, "delete", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            tbl.fold("c-3")
        assert rows(tbl) == want
        monkeypatch.setattr(storage, "delete", real)
    tbl.fold("c-3~")
    assert rows(tbl) == want and len(W.slice_values(spark, tbl.root, W.SLICE)) == 2
    tbl.put("c-5", spark.createDataFrame([(0, 99, ts(50))], SCHEMA))
    tbl.fold("d")
    assert rows(tbl)[0] == (0, 99, ts(50)) and tbl.read().count() == 4


def test_lookback_recovers_late_day(spark, scratch):
    """An event of day D arriving 2.9 days late: a 3-day lookback recomputes
    D, no lookback misses it."""
    d0 = dt.datetime(2024, 1, 1, 12)
    ev = [(1, d0, d0), (2, d0 + dt.timedelta(days=1), d0 + dt.timedelta(days=1)),
          (3, d0 + dt.timedelta(days=2), d0 + dt.timedelta(days=2)),
          (4, d0, d0 + dt.timedelta(days=2.9)),
          (5, d0 + dt.timedelta(days=3), d0 + dt.timedelta(days=3))]
    landing = spark.createDataFrame(
        [(e, e % 2, 7, "C7", "SMB", "view", "m", 10 * e, 200, 40, False, a, b) for e, a, b in ev],
        "event_id bigint, ticket_id bigint, customer_id bigint, customer_name string, segment string, "
        "event_type string, model string, latency_ms int, tokens_in int, tokens_out int, is_escalated boolean, "
        "event_time timestamp_ntz, _ingested_at timestamp_ntz")
    days = jobs.day_windows(dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    counts = {}
    for lookback in (0, 3):
        wh = jobs.Warehouse(spark, scratch(f"late{lookback}"), {"events": landing})
        jobs.backfill(wh, days, only={"events"}, lookback_days=lookback)
        day0 = wh.feature_daily().where(F.col("event_date") == F.lit(dt.date(2024, 1, 1))).first()
        counts[lookback] = day0["n_events"]
    assert counts == {0: 1, 3: 2}


def test_ticket_deleted_in_later_run(spark, scratch):
    """Merge never deletes: a ticket created in run 1 and deleted in run 2
    stays in Gold unless deletes are propagated."""
    cdc = ("op string, ticket_id bigint, cdc_seq int, event_time timestamp_ntz, _ingested_at timestamp_ntz, "
           "customer_id bigint, customer_name string, segment string, priority_raw string, category string, "
           "channel string, status string, csat int, first_response_sec int, subject string, body string")
    d1, d2 = dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 2, 9)
    data = [("c", 1, 0, d1, d1, 1, "A", "S", "2", "bug", "chat", "open", 3, 60, "s", "b"),
            ("d", 1, 1, d2, d2, 1, "A", "S", "2", "bug", "chat", "closed", 3, 60, "s", "b")]
    landing = spark.createDataFrame(data, cdc)
    days = jobs.day_windows(dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    got = {}
    for flag in (False, True):
        wh = jobs.Warehouse(spark, scratch(f"del{flag}"), {"tickets": landing})
        jobs.backfill(wh, days, only={"tickets"}, delete_missing=flag)
        got[flag] = wh.training_set().count()
    assert got == {False: 1, True: 0}


from hypothesis import given, settings, strategies as st  # noqa: E402

_batch = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 99), st.integers(0, 40)), min_size=1, max_size=6)


@settings(max_examples=4, deadline=None)
@given(st.lists(_batch, min_size=1, max_size=3), st.randoms(use_true_random=False))
def test_upsert_is_order_and_replay_free(spark, batches, rnd):
    """Any order of the batches, with any batch replayed, gives the same
    table: per key the row with the latest arrival (ties: larger payload)."""
    from stratum.session import scratch_dir

    frames = [spark.createDataFrame([(k, v, ts(h)) for k, v, h in b], SCHEMA) for b in batches]
    order = list(range(len(frames)))
    rnd.shuffle(order)
    order.append(rnd.choice(order))  # one replay
    tbl = table(spark, scratch_dir(spark, "prop"))
    for n, i in enumerate(order):
        tbl.put(str(n), frames[i])
    expect = {}
    for k, v, h in (x for b in batches for x in b):
        if k not in expect or (h, v) > expect[k]:
            expect[k] = (h, v)
    assert rows(tbl) == sorted((k, v, ts(h)) for k, (h, v) in expect.items())


def test_warehouse_views_for_sql(spark, scratch):
    from stratum.plans import views

    cdc = ("op string, ticket_id bigint, cdc_seq int, event_time timestamp_ntz, _ingested_at timestamp_ntz, "
           "customer_id bigint, customer_name string, segment string, priority_raw string, category string, "
           "channel string, status string, csat int, first_response_sec int, subject string, body string")
    d1 = dt.datetime(2024, 1, 1, 9)
    data = [("c", i, 0, d1, d1, 1, "A", "S", p, "bug", "chat", "open", 3, 60, "s", "b")
            for i, p in enumerate(["1", "high", "P1", "4"])]
    wh = jobs.Warehouse(spark, scratch("views"), {"tickets": spark.createDataFrame(data, cdc)})
    jobs.backfill(wh, jobs.day_windows(dt.date(2024, 1, 1), dt.date(2024, 1, 1)), only={"tickets"})
    names = views.register_views(wh)
    assert {"silver_tickets", "quarantine_tickets", "gold_training_set", "bronze_tickets_cdc"} <= set(names)
    got = spark.sql("select count(*) as n, sum(priority) as s from gold_training_set").first()
    assert (got["n"], got["s"]) == (3, 1 + 2 + 4)
    assert spark.sql("select count(*) from quarantine_tickets").first()[0] == 1
