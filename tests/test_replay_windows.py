"""What a run of many small windows costs: writes and tasks by the rows that arrive, not by the windows there are."""

import datetime as dt

import pytest

from stratum.operators import latest
from stratum.plans import jobs, storage, writers as W
from tests.test_replays import CDC, EVENT, TRANSCRIPT, at, cdc, content, days, event, gold_of, one_shot, transcript

LANDING = {"events": (EVENT, [event(i, at(i % 2), at(i % 2)) for i in range(8)]),
           "tickets": (CDC, [cdc(1, 0, at(0)), cdc(2, 0, at(1)), cdc(1, 1, at(1), "3", "u")]),
           "transcripts": (TRANSCRIPT, [transcript(1, at(0)), transcript(2, at(1)), transcript(1, at(1), "xyz")])}


def warehouse(spark, root):
    return jobs.Warehouse(spark, root, {f: spark.createDataFrame(rows, schema).repartition(4) for f, (schema, rows) in LANDING.items()})


def written(monkeypatch):
    """Paths of all writes from now on."""
    paths = []
    for name in ("replace_slice", "replace_partitions", "append"):
        def write(df, path, *a, real=getattr(W, name), **k):
            paths.append(path)
            return real(df, path, *a, **k)
        monkeypatch.setattr(W, name, write)
    return paths


def test_a_replayed_window_without_rows_writes_bronze_only(spark, scratch, monkeypatch):
    wh = warehouse(spark, scratch("idle"))
    jobs.backfill(wh, days(4), lookback_days=9)
    paths = written(monkeypatch)
    jobs.backfill(wh, days(4)[2:], lookback_days=9)
    assert len(paths) == 6 and all("/bronze/" in p for p in paths)
    for family in jobs.FAMILIES:
        want, got = one_shot(wh, family)
        assert got == want
        assert not storage.list_names(spark, wh.path("_replays", family))


def test_rows_that_arrive_in_a_window_without_rows_are_taken_and_withdrawn(spark, scratch):
    wh = warehouse(spark, scratch("filled"))
    jobs.backfill(wh, days(4), lookback_days=9)
    first = dict(wh.landing)
    more = {"events": [event(1, at(3), at(3), 5), event(90, at(3), at(3))], "tickets": [cdc(2, 1, at(3), "4", "u"), cdc(9, 0, at(3))],
            "transcripts": [transcript(2, at(3), "late"), transcript(9, at(3))]}
    for family, rows in more.items():
        wh.landing[family] = first[family].unionByName(spark.createDataFrame(rows, LANDING[family][0]))
    for landing in (dict(wh.landing), first):
        wh.landing = dict(landing)
        jobs.backfill(wh, days(4), lookback_days=9)
        for family in jobs.FAMILIES:
            want, got = one_shot(wh, family)
            assert got == want, family
        want, got = gold_of(wh, "events")
        assert got == want


@pytest.mark.parametrize("most", [jobs.FEW_ROWS, 2], ids=["one task", "many tasks"])
def test_batches_of_any_size_give_the_same_tables(spark, scratch, monkeypatch, most):
    monkeypatch.setattr(jobs, "FEW_ROWS", most)
    wh = warehouse(spark, scratch("few"))
    for _ in range(2):
        jobs.backfill(wh, days(3), lookback_days=9)
        for family in jobs.FAMILIES:
            want, got = one_shot(wh, family)
            assert got == want, family
            want, got = gold_of(wh, family)
            assert got == want, family
    if most == jobs.FEW_ROWS:
        files = wh.slice_of(dt.date(2024, 1, 1), "silver", "transcripts").inputFiles()
        assert len(files) == 1


def test_a_slice_is_read_without_listing_the_others(spark, scratch, monkeypatch):
    wh = warehouse(spark, scratch("slice"))
    jobs.backfill(wh, days(2))
    day = dt.date(2024, 1, 2)
    whole = wh.silver_events()
    monkeypatch.setattr(W, "read_if_exists", lambda *a: pytest.fail("the whole table was opened"))
    mine = wh.slice_of(day, "silver", "events")
    assert mine.columns == whole.columns
    assert sorted(r[0] for r in mine.select("event_id").collect()) == [1, 3, 5, 7]
    monkeypatch.undo()
    assert wh.slice_of(dt.date(2030, 1, 1), "silver", "events").count() == 0
    assert content(wh.bronze("events", day).drop(jobs.SLICE), *latest.EVENT_COLUMNS) == content(
        wh.landing["events"].where("_ingested_at >= '2024-01-02'"), *latest.EVENT_COLUMNS)


def test_no_family_goes_on_after_one_has_failed(spark, scratch):
    wh = warehouse(spark, scratch("fails"))
    wh.landing["tickets"] = wh.landing["tickets"].drop("csat")
    with pytest.raises(Exception, match="csat"):
        jobs.backfill(wh, days(40))
    assert len(W.slice_values(spark, wh.path("bronze", "events"), jobs.SLICE)) < 40
