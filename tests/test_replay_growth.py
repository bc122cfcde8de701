"""What tickets move in a replay as its tables grow: keys, and the rows that are told apart by them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.plans import jobs, writers as W
from stratum.sources import testdata
from tests.test_replay_cost import plan_of
from tests.test_replays import CDC, at, cdc, content, days

ROWS = "k bigint, n int, v string"


@pytest.fixture(params=[W.SHARED_KEYS, 0], ids=["few shared keys", "many shared keys"])
def shared_keys(request, monkeypatch):
    monkeypatch.setattr(W, "SHARED_KEYS", request.param)
    return request.param


def test_a_sliced_table_compares_rows_of_shared_keys_only(spark, scratch, shared_keys):
    table = W.SlicedTable(spark, scratch("sliced"), "k", ["n"])
    table.put("a", spark.createDataFrame([(1, 1, "a"), (2, 5, "a"), (None, 1, "a")], ROWS))
    assert "Exchange" not in plan_of(table.read())  # one slice
    table.put("b", spark.createDataFrame([(3, 1, "b"), (4, 1, None)], ROWS))
    assert "Exchange" not in plan_of(table.read())  # no key twice
    table.put("c", spark.createDataFrame([(1, 2, "c"), (2, 4, "c"), (None, 1, "c"), (4, 1, "c")], ROWS))
    want = [(1, 2, "c"), (2, 5, "a"), (3, 1, "b"), (4, 1, "c"), (None, 1, "c")]
    assert content(table.read(), "k", "n", "v") == sorted(map(repr, want))
    assert content(table.read(until="b"), "k", "n") == sorted(map(repr, [(1, 1), (2, 5), (3, 1), (4, 1), (None, 1)]))


def test_earlier_records_older_than_the_batch_are_not_compared(spark, scratch, monkeypatch):
    labels, of = [], jobs.scratch_dir
    monkeypatch.setattr(jobs, "scratch_dir", lambda s, label: labels.append(label) or of(s, label))
    wh = jobs.Warehouse(spark, scratch("older"), {"tickets": spark.createDataFrame(
        [cdc(1, 0, at(0)), cdc(2, 0, at(0)), cdc(1, 1, at(1), "3", "u"), cdc(3, 0, at(1))], CDC)})
    jobs.backfill(wh, days(2))
    assert "contested" not in labels
    assert content(wh.silver_tickets(), "ticket_id", "priority") == sorted(map(repr, [(1, 3), (2, 2), (3, 2)]))


def test_a_record_without_a_time_is_compared_with_all(spark, scratch):
    def timeless(row, arrived):
        return tuple(None if i == 3 else arrived if i == 4 else v for i, v in enumerate(row))

    data = spark.createDataFrame([cdc(1, 0, at(0)), timeless(cdc(2, 0, at(0)), at(0)), timeless(cdc(1, 1, at(1), "4"), at(1)),
                                  timeless(cdc(2, 1, at(1), "4"), at(1))], CDC)
    wh = jobs.Warehouse(spark, scratch("timeless"), {"tickets": data})
    jobs.backfill(wh, days(2))
    want = W.collapse(data, "ticket_id", jobs.CDC_ORDER)
    assert content(wh.silver_tickets(), "ticket_id", "priority") == sorted(map(repr, [(1, 2), (2, 4)]))
    assert content(wh.training_set(), "ticket_id", "priority") == sorted(map(repr, [(1, 2), (2, 4)])) and want.count() == 2


def test_change_records_come_from_one_pass_over_the_orders(spark, scratch):
    folder, day = scratch("tables"), dt.datetime(1997, 12, 31)
    orders = [(1, 3, day, "F", "1-URGENT", 100.0), (2, 9, day, "O", "5-LOW", 80000.5), (3, 3, day, "O", "2-HIGH", 7.0),
              (4, None, day, "F", "1-URGENT", 1.0), (5, 20, None, "F", None, 1.0), (6, 8, day, None, "3-MEDIUM", 2.0)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderstatus string, o_orderpriority string, "
                          "o_totalprice double").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(k, f"C{k}", "S") for k in (3, 8, 9, 20)], "c_custkey bigint, c_name string, c_mktsegment string"
                          ).write.parquet(f"{folder}/customer.parquet")
    got = testdata.fx_cdc(spark, folder)
    assert plan_of(got).count("FileScan parquet") == 2
    key = [(1, 0, "c"), (1, 1, "d"), (2, 0, "c"), (2, 2, "u"), (3, 0, "c"), (3, 2, "u"), (5, 0, "c"), (5, 1, "d"), (6, 0, "c")]
    assert content(got, "ticket_id", "cdc_seq", "op") == sorted(map(repr, key))
    late = got.where((F.col("ticket_id") == 2) & (F.col("op") == "u")).first()  # a bad priority, four days later
    assert late.event_time == day + dt.timedelta(days=4) and late.priority_raw == "  "
