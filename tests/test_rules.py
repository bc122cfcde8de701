"""Column rules: normalisation, reject reasons, rounding, time differences."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stratum.functions import normalize as N
from stratum.functions.numeric import round_scaled, to_int_half_even
from stratum.functions.timefn import hours_crossed, seconds_between


def _norm(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "p string")
    rows = df.select(N.normalize_domain("p").alias("n"), N.reject_reason("p").alias("r")).collect()
    return [r["n"] for r in rows], [r["r"] for r in rows]


def test_normalisation_groups(spark):
    got, reasons = _norm(spark, ["1", "4", " 3 ", "+2", "Urgent", " LOW "])
    assert got == [1, 4, 3, 2, 1, 4]
    assert reasons == [None] * 6


def test_rejections_and_reasons(spark):
    values = ["0", "5", "-1", "", None, "P1", "unknown", "3.7", "1e0"]
    got, reasons = _norm(spark, values)
    assert got == [None] * len(values)
    assert reasons == [N.REASON_OUT_OF_RANGE] * 3 + [N.REASON_EMPTY, N.REASON_NULL] + [N.REASON_UNKNOWN] * 4


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=6), st.integers(-3, 8).map(str)), min_size=1, max_size=20))
def test_accept_reject_is_a_partition(spark, values):
    got, reasons = _norm(spark, values)
    for n, r in zip(got, reasons):
        assert (n is None) != (r is None)
        assert n is None or 1 <= n <= 4


def test_rounding_to_int_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (545.4999999999999,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(to_int_half_even(F.col("x"))).collect()] == [2, 4, 546, 0]


def test_scaled_round(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (10.0 / 3,)], "x double")
    got = [r[0] for r in df.select(round_scaled(F.col("x"), 2)).collect()]
    assert got == [round(1.005 * 100) / 100, round(2.675 * 100) / 100, 3.33]


def test_boundaries_crossed(spark):
    a = dt.datetime(2024, 1, 1, 0, 59, 59)
    b = dt.datetime(2024, 1, 1, 1, 0, 1)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(hours_crossed(F.col("a"), F.col("b")).alias("h"),
                  seconds_between(F.col("a"), F.col("b")).alias("s")).first()
    assert (r["h"], r["s"]) == (1, 2)
