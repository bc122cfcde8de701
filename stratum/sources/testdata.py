"""Bronze stand-ins derived from the shared Parquet test tables.

Every fixture reads whole tables and derives its rows by column arithmetic,
so its size grows with the input. The same derivations exist as SQL text in
``stratum.oracle`` for the DuckDB cross-check; the two must stay in step.

* ``fx_events``       — event deliveries, with late arrivals and re-deliveries
* ``fx_cdc``          — ticket change records (create / delete / update) with a
                        priority column that changes format and has bad values
* ``fx_transcripts``  — transcript deliveries assembled from conversation turns
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratum.functions.timefn import add_seconds
from stratum.plans import storage

# --- fixed values ------------------------------------------------------------
# Label format of the priority column starts at this instant in fx_cdc.
LABEL_FORMAT_FROM = "1998-01-01 00:00:00"
PRIORITY_LABEL_OF = ["urgent", "high", "medium", "low"]  # code 1..4
# Values of the four reject classes: none, empty, out of range, unknown text.
BAD_PRIORITY_VALUES = [None, "", "  ", "7", "-2", "40", "soon", "3rd"]
STATUSES = ["open", "pending", "resolved", "closed"]
LANGS = ["en", "fr", "de", "es"]
# Run windows of the CDC replays (yearly; the CDC spans about six years).
CDC_RUN_BOUNDS = ["1996-01-01", "1997-01-01", "1998-01-01", "1999-01-01", "2000-01-01", "2001-01-01"]
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def land(df: DataFrame, path: str) -> DataFrame:
    """Write a derived source once as Parquet files (the landing zone) and
    read it back, so that replays scan files with pushed-down filters
    instead of re-deriving the source per run."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def content_key(spark: SparkSession, sf_dir: str) -> tuple:
    """Names what a session derived from the tables of a folder: changed files give another key."""
    return (spark.sparkContext.applicationId, sf_dir, storage.fingerprint(spark, sf_dir))


_LANDED: dict[tuple, str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture ``name`` (``events``, ``cdc``, ``transcripts``) as landed
    Parquet files: derived from the test tables once per session and input
    folder, then read like any landing zone."""
    from stratum.session import scratch_dir

    key = (content_key(spark, sf_dir), name)
    if key not in _LANDED:
        derive = {"events": fx_events, "events_skewed": fx_events_skewed, "cdc": fx_cdc,
                  "transcripts": fx_transcripts}[name]
        path = scratch_dir(spark, f"landing-{name}")
        land(derive(spark, sf_dir), path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def _pick(index: Column, values: list) -> Column:
    """``values[index]`` as a CASE chain (NULL entries allowed)."""
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        out = F.when(index == i, lit) if out is None else out.when(index == i, lit)
    return out


def fx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze event deliveries: one row per delivery of an event.

    The delay follows the event's own ``value``: events of the upper tail arrive
    one to three days late. Those of some users are delivered a second time, about
    3.5 days later, with a corrected ``latency_ms``. Name and segment are those of the
    customer with the user's number.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    e = table(spark, sf_dir, "events").join(c, F.col("user_id") == F.col("c_custkey"), "left")
    eid = F.col("event_id")

    def shape(latency: Column, delay_sec: Column) -> list[Column]:
        return [
            eid.alias("event_id"),
            (eid % 997).alias("ticket_id"),
            F.col("user_id").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("event_type"),
            F.concat(F.lit("m"), (F.get_json_object("props", "$.k").cast("int") % 4).cast("string")).alias("model"),
            latency.alias("latency_ms"),
            (F.char_length("event_type") * 30 + F.col("user_id") % 60).cast("int").alias("tokens_in"),
            (F.char_length("props") * 4).cast("int").alias("tokens_out"),
            (F.col("event_type") == "error").alias("is_escalated"),
            F.col("ts").alias("event_time"),
            add_seconds(F.col("ts"), delay_sec).alias("_ingested_at"),
        ]

    base_latency = F.floor(F.col("value") * 10).cast("int")
    first = e.select(*shape(
        base_latency,
        F.floor(F.when(F.col("value") > 150, F.col("value") * 600).otherwise(F.col("value") * 60)),
    ))
    again = e.where(F.col("user_id") % 40 == 7).select(*shape(
        base_latency + 1,
        F.floor(F.col("value") * 20) + 300000,
    ))
    return first.unionByName(again)


def fx_events_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_events`` with one hot customer: every third event belongs to customer 1, under its name and segment."""
    ev = fx_events(spark, sf_dir)
    one = table(spark, sf_dir, "customer").where("c_custkey = 1").select("c_name", "c_mktsegment")
    hot = F.col("event_id") % 3 == 1
    return (ev.withColumn("customer_id", F.when(hot, F.lit(1).cast("long")).otherwise(F.col("customer_id")))
              .withColumn("customer_name", F.when(hot, one.select("c_name").scalar()).otherwise(F.col("customer_name")))
              .withColumn("segment", F.when(hot, one.select("c_mktsegment").scalar()).otherwise(F.col("segment"))))


def fx_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ticket CDC: one row per change record ``(ticket_id, cdc_seq)``.

    Every order is created (seq 0); finished orders of some customers are deleted
    six hours later (seq 1); open orders of some customers are updated days later
    (seq 2), a part of them with a bad priority. Priorities are the order's own
    digit before ``LABEL_FORMAT_FROM`` and labels after it.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                                "o_orderstatus", "o_orderpriority", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    key = F.col("o_orderkey")
    # Orders are read, and joined, once; their records follow from the joined row. A regular join: customer grows with
    # the data, so Catalyst decides between broadcast (by its size statistics) and a shuffle join.
    base = o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment",
        F.floor("o_totalprice").alias("price"),
        add_seconds(F.col("o_orderdate"), F.floor("o_totalprice") % 80000).alias("t0"),
        F.least(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(4)).alias("pcode"),
    )

    def record(op: str, seq: int, event_time: Column, is_bad: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), F.lit(seq).alias("cdc_seq"), event_time.alias("event_time"), is_bad.alias("is_bad"))

    t0 = F.col("t0")
    records = F.array(
        record("c", 0, t0, F.lit(False)),
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_custkey") % 17 == 3),
               record("d", 1, add_seconds(t0, 21600), F.lit(False))),
        F.when((F.col("o_orderstatus") == "O") & (F.col("o_custkey") % 3 == 0),
               record("u", 2, add_seconds(t0, F.col("pcode") * 86400), F.col("o_custkey") % 4 == 1)))
    ops = base.select("*", F.inline(records)).where(F.col("op").isNotNull())

    label_time = F.col("event_time") >= F.lit(LABEL_FORMAT_FROM).cast("timestamp_ntz")
    bad_idx = (key % 8).cast("int")
    priority_raw = (
        F.when(F.col("is_bad"), _pick(bad_idx, BAD_PRIORITY_VALUES))
        .when(label_time, _pick(F.col("pcode") - 1, PRIORITY_LABEL_OF))
        .otherwise(F.col("pcode").cast("string"))
    )
    status = (F.when(F.col("op") == "d", F.lit("closed"))
              .when(F.col("op") == "c", F.lit("open"))
              .otherwise(_pick(F.col("pcode") - 1, STATUSES)))
    return ops.select(
        "op",
        key.alias("ticket_id"),
        "cdc_seq",
        "event_time",
        F.col("event_time").alias("_ingested_at"),
        F.col("o_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        priority_raw.alias("priority_raw"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderstatus").alias("channel"),
        status.alias("status"),
        (F.col("pcode") + 1).alias("csat"),
        (F.col("price") % 3600).cast("int").alias("first_response_sec"),
        F.concat(F.lit("Order "), key.cast("string")).alias("subject"),
        F.concat(F.col("o_orderpriority"), F.lit(" / "), F.col("o_orderstatus")).alias("body"),
    )


def fx_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze transcript deliveries: turns of a conversation as one array.

    Every 10th conversation is delivered twice, the second time 2 hours later.
    """
    from stratum.operators.chunks import assemble_turns

    conv = table(spark, sf_dir, "conversations")
    turns = assemble_turns(conv, "conv_id", "turn", "text")
    cid = F.col("conv_id")
    t0 = add_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), cid * 3600)

    def shape(delay: Column) -> list[Column]:
        return [
            cid.alias("transcript_id"),
            (cid % 997).alias("ticket_id"),
            _pick(cid % 4, LANGS).alias("lang"),
            F.col("turns"),
            t0.alias("event_time"),
            add_seconds(t0, delay).alias("_ingested_at"),
        ]

    first = turns.select(*shape((cid % 7) * 60))
    again = turns.where(cid % 10 == 3).select(*shape(F.lit(7200) + cid % 7))
    return first.unionByName(again)

