"""What a run of a replay moves and asks for, with the results it must keep."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.operators import features, latest, training
from stratum.plans import jobs, writers as W
from tests.test_replays import CDC, EVENT, at, cdc, content, days, event


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_need_no_object_buffers_and_one_exchange(spark):
    rows = [(*event(i, at(0), at(0), lat)[:1], i % 3, who, f"C{who}", None if who == 2 else "S", "view", "m", lat, 1, 2, i % 2 == 0,
             at(0), at(0)) for i, (who, lat) in enumerate([(1, 5), (1, 5), (1, 90), (1, None), (2, None), (2, None), (3, 7), (None, 1), (None, 2)]
                                                         + [(4, (i * 37) % 101) for i in range(101)])]
    silver = latest.event_shape(spark.createDataFrame(rows, EVENT))
    got = features.feature_daily(silver)
    want = silver.groupBy(*features.FEATURE_GROUP).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("ticket_id").alias("n_tickets"), F.count_if("is_escalated").alias("n_escalated"),
        features.round_scaled(F.avg("latency_ms"), 2).alias("avg_latency_ms"),
        features.to_int_half_even(F.percentile("latency_ms", 0.95)).alias("p95_latency_ms"),
        F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert content(got, *want.columns) == content(want, *want.columns)
    plan = plan_of(got)
    assert "ObjectHashAggregate" not in plan and plan.count("Exchange ") == 1


def test_a_customer_with_two_names_on_a_day_leaves_gold_as_it_was(spark, scratch):
    first, again = event(1, at(0), at(0)), event(2, at(0), at(1))
    wh = jobs.Warehouse(spark, scratch("names"), {"events": spark.createDataFrame([first], EVENT)})
    jobs.backfill(wh, days(1))
    before = content(wh.feature_daily(), *features.FEATURE_KEY, "n_events")
    wh.landing["events"] = spark.createDataFrame([first, (*again[:3], "other", *again[4:])], EVENT)
    with pytest.raises(W.DuplicateKeyError):
        jobs.run_window(wh, *days(2)[1])
    assert content(wh.feature_daily(), *features.FEATURE_KEY, "n_events") == before


def test_whole_earlier_rows_are_read_of_contested_tickets_only(spark, scratch, monkeypatch):
    def late(row, arrived, **change):
        names = [f.split()[0] for f in CDC.split(", ")]
        return tuple(change.get(n, arrived if n == "_ingested_at" else v) for n, v in zip(names, row))

    base = [cdc(t, 0, at(0)) for t in (1, 2, 3, 4, None)]
    # 1: newer; 2: older than what is there; 3: same time, other text, loses; 5: same time, wins; None: deleted
    base += [cdc(5, 0, at(0)), cdc(2, 1, at(0, 12), "3", "u")]
    more = [cdc(1, 1, at(1), "3", "u"), late(cdc(2, 0, at(0), "4"), at(1)), late(cdc(3, 0, at(0)), at(1), op="a", body="a"),
            late(cdc(5, 0, at(0)), at(1), op="u", body="z"), cdc(None, 1, at(1), "2", "d"), cdc(6, 0, at(1)), late(cdc(4, 0, at(0)), at(1))]
    data = spark.createDataFrame(base + more, CDC)
    asked, read = [], W.SlicedTable.read

    def reading(self, until=None, keys=None):
        if keys is not None:
            asked.extend(r[0] for r in keys.collect())
        return read(self, until, keys)

    monkeypatch.setattr(W.SlicedTable, "read", reading)
    wh = jobs.Warehouse(spark, scratch("contested"), {"tickets": data})
    jobs.backfill(wh, days(2))
    assert sorted(asked) == [2, 3, 4, 5]
    order = ["ticket_id", "event_time", "cdc_seq", "op", "body"]
    held = W.collapse(data.withColumn("_priority", F.col("priority_raw").cast("int")), "ticket_id", jobs.CDC_ORDER)
    assert content(wh.ticket_state().read(), *order) == content(held, *order)
    want = training.training_set(wh.silver_tickets()).unionByName(
        training.training_set(latest.silver_tickets(data.where("_ingested_at < '2024-01-02'"))).where("ticket_id is null"))
    assert content(wh.training_set(), *want.columns) == content(want, *want.columns)


def test_counting_the_training_set_moves_keys_only(spark, scratch):
    wh = jobs.Warehouse(spark, scratch("narrow"), {"tickets": spark.createDataFrame([cdc(1, 0, at(0)), cdc(1, 1, at(1))], CDC)})
    jobs.backfill(wh, days(2))
    rows = wh.training_set().agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ticket_id").alias("k"))
    assert tuple(rows.first()) == (1, 1) and "csat" not in plan_of(rows)


def test_a_known_table_is_opened_without_a_job(spark, scratch):
    wh = jobs.Warehouse(spark, scratch("known"), {"events": spark.createDataFrame([event(1, at(0), at(0))], EVENT)})
    jobs.backfill(wh, days(1))
    wh.silver_events(), wh.feature_daily()
    spark.sparkContext.setJobGroup("open-known", "")
    try:
        assert wh.silver_events().columns and wh.feature_daily().columns
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("open-known")
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_a_key_held_by_one_snapshot_only_is_changed(spark, scratch):
    wh = jobs.Warehouse(spark, scratch("snap"), {"events": spark.createDataFrame([event(i, at(0), at(0)) for i in (1, 2)], EVENT)})
    jobs.backfill(wh, days(1))
    intent = jobs.Intent(wh, "events", dt.date(2024, 1, 1))
    for kept in ((1, 2), (1, 2, 2, 3), (1, None)):
        intent._write("before", spark.createDataFrame([(k, 0, None) for k in kept], "key bigint, version bigint, day date"))
    assert sorted((r[0] for r in intent.changed().collect()), key=str) == [2, 3, None]
