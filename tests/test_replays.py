"""Replays of runs: long chains, corrections, removals, crashes between writes."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from stratum.operators import chunks, features, latest, quarantine, training
from stratum.plans import jobs, storage, writers as W
from stratum.sources import files

EVENT = ("event_id bigint, ticket_id bigint, customer_id bigint, customer_name string, segment string, "
         "event_type string, model string, latency_ms int, tokens_in int, tokens_out int, is_escalated boolean, "
         "event_time timestamp_ntz, _ingested_at timestamp_ntz")
TRANSCRIPT = ("transcript_id bigint, ticket_id bigint, lang string, turns array<string>, event_time timestamp_ntz, "
              "_ingested_at timestamp_ntz")
CDC = ("op string, ticket_id bigint, cdc_seq int, event_time timestamp_ntz, _ingested_at timestamp_ntz, "
       "customer_id bigint, customer_name string, segment string, priority_raw string, category string, "
       "channel string, status string, csat int, first_response_sec int, subject string, body string")
D0 = dt.date(2024, 1, 1)


def at(day, hour=9, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute) + dt.timedelta(days=day)


def event(i, when, arrived, latency=1):
    return (i, 1, 7, "C7", "SMB", "view", "m", latency, 1, 1, False, when, arrived)


def transcript(i, arrived, turns=("a", "b")):
    return (i, 1, "en", list(turns), arrived, arrived)


def cdc(ticket, seq, when, prio="2", op="c", status="open"):
    return (op, ticket, seq, when, when, 1, "A", "S", prio, "bug", "chat", status, 3, 60, "s", "b")


def days(n):
    return jobs.day_windows(D0, D0 + dt.timedelta(days=n - 1))


def content(df, *cols):
    return sorted(map(repr, (tuple(r) for r in df.select(*cols).collect())))


def test_chunks_after_40_daily_runs_equal_the_one_shot_build(spark, scratch):
    data = spark.createDataFrame([transcript(i, at(i)) for i in range(40)], TRANSCRIPT)
    wh = jobs.Warehouse(spark, scratch("long"), {"transcripts": data})
    jobs.backfill(wh, days(40))
    want = chunks.doc_chunks(latest.silver_transcripts(data))
    assert content(wh.doc_chunks(), *want.columns) == content(want, *want.columns)


def test_event_time_corrected_over_midnight_is_one_event(spark, scratch):
    data = spark.createDataFrame([event(1, at(0, 23, 59), at(0, 23, 59)), event(1, at(1, 0, 1), at(1, 0, 2)),
                                  event(None, at(0), at(0)), event(None, at(0), at(1))], EVENT)
    wh = jobs.Warehouse(spark, scratch("corr"), {"events": data})
    jobs.backfill(wh, days(2))
    jobs.backfill(wh, days(2))
    want = latest.silver_events(data)
    assert content(wh.silver_events(), *want.columns) == content(want, *want.columns)
    assert wh.feature_daily().agg(F.sum("n_events")).first()[0] == 2


def test_replay_of_an_earlier_day_decides_later_days_anew(spark, scratch):
    first = [event(1, at(0), at(0), 10), event(2, at(0), at(0))]
    again = [event(1, at(0), at(2), 99), event(3, at(2), at(2))]
    wh = jobs.Warehouse(spark, scratch("redo"), {"events": spark.createDataFrame(first + again, EVENT)})
    jobs.backfill(wh, days(3))
    assert content(wh.silver_events(), "event_id", "latency_ms") == content(
        spark.createDataFrame([(1, 10), (2, 1), (3, 1)], "a long, b int"), "a", "b")
    wh.landing["events"] = spark.createDataFrame(first[1:] + again, EVENT)  # the first delivery was withdrawn
    jobs.run_window(wh, *days(1)[0])
    got = {r["event_id"]: r["latency_ms"] for r in wh.silver_events().collect()}
    assert got == {1: 99, 2: 1, 3: 1}


def test_empty_replay_removes_the_slice(spark, scratch):
    data = spark.createDataFrame([event(1, at(0), at(0))], EVENT)
    wh = jobs.Warehouse(spark, scratch("empty"), {"events": data})
    jobs.backfill(wh, days(1))
    wh.landing["events"] = data.limit(0)
    jobs.backfill(wh, days(1))
    assert wh.bronze("events").count() == 0 and (wh.silver_events() is None or wh.silver_events().count() == 0)


def test_quarantine_keeps_every_rejected_delivery_once(spark, scratch):
    bad = [cdc(1, 0, at(0), "x"), cdc(None, 1, at(0), None)]
    again = [(*bad[0][:4], at(1), *bad[0][5:])]
    data = spark.createDataFrame(bad + again, CDC)
    wh = jobs.Warehouse(spark, scratch("quar"), {"tickets": data})
    for _ in range(3):
        jobs.backfill(wh, days(2))
    want = quarantine.quarantine_tickets(data)
    assert content(wh.quarantine(), *want.columns) == content(want, *want.columns)
    assert wh.quarantine().count() == 3


def test_correction_in_a_replayed_day_reaches_silver_tickets(spark, scratch):
    rows = [cdc(1, 0, at(0)), cdc(2, 0, at(0)), cdc(1, 1, at(1), "3", "u")]
    wh = jobs.Warehouse(spark, scratch("fix"), {"tickets": spark.createDataFrame(rows, CDC)})
    jobs.backfill(wh, days(2))
    fixed = [cdc(2, 0, at(0), "4"), cdc(1, 0, at(0))]  # the update of day 1 was withdrawn
    wh.landing["tickets"] = spark.createDataFrame(fixed, CDC)
    jobs.backfill(wh, days(2))
    want = latest.silver_tickets(wh.landing["tickets"])
    assert content(wh.silver_tickets(), *want.columns) == content(want, *want.columns)


def dying(monkeypatch, call):
    """The ``call``-th write from now on fails (of slices, partitions, intents, markers and removals)."""
    n = {"n": 0}

    def guard(real):
        def write(*a, **k):
            n["n"] += 1
            if n["n"] == call:
                raise OSError("lost")
            return real(*a, **k)
        return write

    for module, name in [(W, "replace_slice"), (W, "replace_partitions"), (storage, "create_text"), (storage, "delete")]:
        monkeypatch.setattr(module, name, guard(getattr(module, name)))
    return n


def one_shot(wh, family):
    """The family's Silver table from all of the landing in one pass, and the one the runs left."""
    df = wh.landing[family]
    want = {"events": latest.silver_events, "tickets": latest.silver_tickets, "transcripts": latest.silver_transcripts}[family](df)
    got = {"events": wh.silver_events, "tickets": wh.silver_tickets, "transcripts": wh.silver_transcripts}[family]()
    return content(want, *want.columns), [] if got is None else content(got, *want.columns)


def gold_of(wh, family):
    if family == "events":
        want = features.feature_daily(latest.silver_events(wh.landing["events"]))
        return content(want, *want.columns), content(wh.feature_daily(), *want.columns)
    if family == "transcripts":
        want = chunks.doc_chunks(latest.silver_transcripts(wh.landing["transcripts"]))
        return content(want, *want.columns), content(wh.doc_chunks(), *want.columns)
    want = training.training_set(latest.silver_tickets(wh.landing["tickets"]))
    got = wh.training_set()
    return content(want, *want.columns), content(got, *want.columns)


# per family: landing before, landing after a correction of day 0 (rows withdrawn, some delivered again on day 1)
CORRECTED = {
    "events": (EVENT, [event(1, at(0), at(0), 10), event(1, at(0), at(1), 99), event(2, at(0), at(0)), event(3, at(1), at(1)), event(4, at(2), at(2))],
               [event(1, at(0), at(1), 99), event(2, at(0), at(0)), event(3, at(1), at(1)), event(4, at(2), at(2))]),
    "tickets": (CDC, [cdc(1, 0, at(0)), cdc(2, 0, at(0)), cdc(1, 1, at(1), "3", "u"), cdc(3, 0, at(2))],
                [cdc(2, 0, at(0), "4"), cdc(1, 1, at(1), "3", "u"), cdc(3, 0, at(2))]),
    "transcripts": (TRANSCRIPT, [transcript(1, at(0)), transcript(1, at(1), "xyz"), transcript(2, at(0)), transcript(3, at(2))],
                    [transcript(1, at(1), "xyz"), transcript(2, at(0)), transcript(3, at(2))]),
}


@pytest.mark.parametrize("family", CORRECTED)
def test_a_run_that_died_at_any_write_is_repaired_by_running_again(spark, scratch, family):
    """First runs and replays of all families, failing at each write in turn, also twice in a row."""
    schema, before, after = CORRECTED[family]
    old, new = (spark.createDataFrame(x, schema) for x in (before, after))
    loaded = jobs.Warehouse(spark, scratch(f"die-{family}"), {family: old})
    jobs.backfill(loaded, days(3), lookback_days=0)
    call, died = 1, True
    while died:  # until the replay makes fewer writes than that
        wh = jobs.Warehouse(spark, scratch(f"die-{family}"), {family: new})
        shutil.copytree(loaded.root, wh.root)
        for attempt in (call, 2) if call % 3 == 0 else (call,):
            with pytest.MonkeyPatch.context() as patch:
                dying(patch, attempt)
                try:
                    jobs.run_window(wh, *days(1)[0], lookback_days=0)
                    died = attempt != call and died
                except OSError:
                    died = True
            if not died:
                break
        jobs.run_window(wh, *days(1)[0], lookback_days=0)
        want, got = one_shot(wh, family)
        assert got == want, call
        want, got = gold_of(wh, family)
        assert got == want, call
        assert not storage.list_names(spark, wh.path("_replays", family))
        call += 1
    assert call > 4


@pytest.mark.parametrize("family", CORRECTED)
@pytest.mark.parametrize("call", [1, 2, 3])
def test_a_first_run_that_died_is_repaired_by_running_again(spark, scratch, family, call):
    schema, before, _ = CORRECTED[family]
    wh = jobs.Warehouse(spark, scratch("die1"), {family: spark.createDataFrame(before, schema)})
    with pytest.MonkeyPatch.context() as patch:
        dying(patch, call)
        with pytest.raises(OSError):
            jobs.backfill(wh, days(3))
    jobs.backfill(wh, days(3))
    want, got = one_shot(wh, family)
    assert got == want
    want, got = gold_of(wh, family)
    assert got == want


def test_days_loaded_out_of_order_equal_the_one_shot_build(spark, scratch):
    for family, (schema, before, _) in CORRECTED.items():
        wh = jobs.Warehouse(spark, scratch("order"), {family: spark.createDataFrame(before, schema)})
        for w in (days(3)[2], days(3)[1], days(3)[0]):
            jobs.run_window(wh, *w, lookback_days=9)
        want, got = one_shot(wh, family)
        assert got == want, family


def test_a_day_that_lost_all_rows_leaves_gold(spark, scratch):
    rows = [event(1, at(0), at(0)), event(2, at(5), at(5))]
    wh = jobs.Warehouse(spark, scratch("emptied"), {"events": spark.createDataFrame(rows, EVENT)})
    jobs.backfill(wh, days(6), lookback_days=0)
    assert wh.feature_daily().agg(F.sum("n_events")).first()[0] == 2
    wh.landing["events"] = spark.createDataFrame(rows[:1], EVENT)
    jobs.run_window(wh, *days(6)[5], lookback_days=0)
    assert wh.silver_events().count() == 1 and wh.feature_daily().agg(F.sum("n_events")).first()[0] == 1
    # the lookback anchor went down with it: a late row of day 0 is within a lookback of 0 again
    wh.landing["events"] = spark.createDataFrame(rows[:1] + [event(3, at(0), at(6))], EVENT)
    jobs.run_window(wh, *days(7)[6], lookback_days=0)
    assert wh.feature_daily().agg(F.sum("n_events")).first()[0] == 2


def test_a_withdrawn_batch_leaves_gold_too(spark, scratch):
    wh = jobs.Warehouse(spark, scratch("gone"), {"tickets": spark.createDataFrame([cdc(1, 0, at(0)), cdc(2, 0, at(1))], CDC)})
    jobs.backfill(wh, days(2))
    wh.landing["tickets"] = spark.createDataFrame([cdc(2, 0, at(1)), cdc(2, 1, at(1, 12), op="d")], CDC)
    jobs.backfill(wh, days(2))
    assert wh.silver_tickets().count() == 0
    # a merge never deletes, but a batch that is decided anew is replaced: neither ticket is live in any of them
    assert wh.training_set().count() == 0


def test_a_run_goes_on_over_malformed_lines(spark, scratch):
    path, data = scratch("raw"), spark.createDataFrame([cdc(1, 0, at(0)), cdc(2, 0, at(0), "bad"), cdc(3, 0, at(1))], CDC)
    files.export_jsonl(data, path)
    spark.createDataFrame([('{"op": "c", "ticket_id": ',), ('{"op": "c", "ticket_id": "x"}',), ("",)], "v string").write.mode("append").text(path)
    wh = jobs.Warehouse(spark, scratch("lines"))
    for _ in range(2):
        rejected = jobs.land_lines(wh, "tickets", path, CDC, D0)
        jobs.backfill(wh, days(2))
    assert sorted(r["reject_reason"] for r in rejected.collect()) == sorted([files.NOT_JSON, files.WRONG_TYPE])
    assert wh.silver_tickets().count() == 2 and wh.quarantine().count() == 1


def test_missing_column_fails(spark):
    data = spark.createDataFrame([cdc(1, 0, at(0))], CDC).drop("csat")
    with pytest.raises(Exception, match="csat"):
        latest.silver_tickets(data).collect()
