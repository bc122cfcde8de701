"""What events move in a replay as their table grows: ids, and the rows that are told apart by them."""

import pytest

from stratum.operators import features, latest
from stratum.plans import jobs, writers as W
from tests.test_replay_cost import plan_of
from tests.test_replays import EVENT, TRANSCRIPT, at, content, days, event, transcript


@pytest.fixture(params=[W.SHARED_KEYS, 0], ids=["few shared keys", "many shared keys"])
def shared_keys(request, monkeypatch):
    monkeypatch.setattr(W, "SHARED_KEYS", request.param)
    return request.param


def test_rows_of_a_batch_without_repeats_are_not_moved_to_be_compared(spark, scratch, monkeypatch):
    plans, put = [], W.replace_slice

    def replacing(df, path, *args, **kw):
        if "/silver/" in path:
            plans.append(plan_of(df))
        return put(df, path, *args, **kw)

    monkeypatch.setattr(W, "replace_slice", replacing)
    wh = jobs.Warehouse(spark, scratch("once"), {"events": spark.createDataFrame([event(i, at(i % 2), at(i % 2)) for i in range(6)], EVENT)})
    jobs.backfill(wh, days(2))
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)


def test_first_deliveries_of_any_number_of_repeats(spark, scratch, shared_keys):
    rows = [event(1, at(0), at(0), 5), event(1, at(0), at(0), 3), event(2, at(0), at(0)), event(2, at(0), at(1), 9), event(3, at(1), at(1), 2),
            event(3, at(0), at(1), 1), event(None, at(0), at(0)), event(None, at(1), at(1)), event(4, at(1), at(1)), event(4, at(1), at(2))]
    data = spark.createDataFrame(rows, EVENT)
    turns = spark.createDataFrame([transcript(1, at(0)), transcript(1, at(0, 10), ("x",)), transcript(1, at(1), ("y",)),
                                   transcript(None, at(0)), transcript(None, at(1), ("z",)), transcript(2, at(1))], TRANSCRIPT)
    wh = jobs.Warehouse(spark, scratch("repeats"), {"events": data, "transcripts": turns})
    jobs.backfill(wh, days(3), lookback_days=10)
    for got, want in [(wh.silver_events(), latest.first_arrival(latest.event_shape(data), "event_id")),
                      (wh.silver_transcripts(), latest.silver_transcripts(turns))]:
        assert content(got, *want.columns) == content(want, *want.columns)


def test_daily_features_hash_no_row_by_its_ticket(spark):
    rows = [(*event(i, at(0), at(0), i)[:1], t, *event(i, at(0), at(0), i)[2:]) for i, t in enumerate([4, 4, None, 5, None, 4])]
    silver = latest.event_shape(spark.createDataFrame(rows, EVENT))
    assert plan_of(features.feature_daily(silver)).count("HashAggregate") == 2
    assert [r.n_tickets for r in features.feature_daily(silver).collect()] == [2]
    alone = features.feature_daily(silver.where("ticket_id is null"))
    assert [r.n_tickets for r in alone.collect()] == [0]
