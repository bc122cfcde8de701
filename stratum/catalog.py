"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry reads the test tables through ``stratum.sources.testdata`` and
runs one operator (or one job) of the package over all of their rows. The
matching SQL lives under the same name in ``stratum.oracle.SQL``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratum.operators import (chunks, diagnostics, features, joins, lateness, latest, quality, quarantine,
                               sampling, training)
from stratum.functions import timefn as tf
from stratum.plans import jobs, layout, views
from stratum.plans import writers as W
from stratum.session import scratch_dir
from stratum.sources import files
from stratum.streaming import ingest
from stratum.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- building blocks ---------------------------------------------------------------

def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.silver_events(td.landed(spark, sf_dir, "events"))


def silver_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.silver_tickets(td.landed(spark, sf_dir, "cdc"))


# --- slice 1: events -> features ---------------------------------------------------

@query("silver_events")
def q_silver_events(spark, sf_dir):
    return silver_events(spark, sf_dir)


@query("feature_daily_full")
def q_feature_daily_full(spark, sf_dir):
    return features.feature_daily(silver_events(spark, sf_dir))


# --- slice 2: CDC -> Silver tickets, quarantine, Gold training set -----------------

@query("silver_tickets")
def q_silver_tickets(spark, sf_dir):
    return silver_tickets(spark, sf_dir)


@query("quarantine_tickets")
def q_quarantine_tickets(spark, sf_dir):
    return quarantine.quarantine_tickets(td.landed(spark, sf_dir, "cdc"))


@query("split_reconciliation")
def q_split_reconciliation(spark, sf_dir):
    return quarantine.split_reconciliation(td.landed(spark, sf_dir, "cdc"))


@query("rank_then_filter_loss")
def q_rank_then_filter_loss(spark, sf_dir):
    return latest.rank_then_filter_loss(td.landed(spark, sf_dir, "cdc"))


@query("normalize_priority")
def q_normalize_priority(spark, sf_dir):
    return quarantine.normalized_records(td.landed(spark, sf_dir, "cdc"))


@query("reject_reasons")
def q_reject_reasons(spark, sf_dir):
    return quarantine.reject_reason_counts(td.landed(spark, sf_dir, "cdc"))


@query("value_distribution")
def q_value_distribution(spark, sf_dir):
    return diagnostics.value_distribution(td.landed(spark, sf_dir, "cdc"), "priority_raw")


@query("schema_change_by_day")
def q_schema_change_by_day(spark, sf_dir):
    return diagnostics.non_numeric_by_day(td.landed(spark, sf_dir, "cdc"))


@query("cdc_op_counts")
def q_cdc_op_counts(spark, sf_dir):
    return diagnostics.op_counts(td.landed(spark, sf_dir, "cdc"))


@query("cdc_union")
def q_cdc_union(spark, sf_dir):
    """The CDC log as the UNION ALL of its create, delete and update records."""
    return td.fx_cdc(spark, sf_dir)


@query("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    return diagnostics.duplicate_keys(td.landed(spark, sf_dir, "cdc"), "ticket_id")


@query("rows_vs_distinct")
def q_rows_vs_distinct(spark, sf_dir):
    return diagnostics.rows_vs_distinct(td.landed(spark, sf_dir, "cdc"), "ticket_id")


@query("training_set")
def q_training_set(spark, sf_dir):
    return training.training_set(silver_tickets(spark, sf_dir))


# --- slice 3: transcripts -> chunks ------------------------------------------------

@query("silver_transcripts")
def q_silver_transcripts(spark, sf_dir):
    return latest.silver_transcripts(td.landed(spark, sf_dir, "transcripts"))


@query("transcripts_from_turns")
def q_transcripts_from_turns(spark, sf_dir):
    return chunks.assemble_turns(td.table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@query("doc_chunks")
def q_doc_chunks(spark, sf_dir):
    return chunks.doc_chunks(latest.silver_transcripts(td.landed(spark, sf_dir, "transcripts")))


# --- slice 4: lateness and skew -----------------------------------------------------

@query("lateness_profile")
def q_lateness_profile(spark, sf_dir):
    return lateness.lateness_profile(td.landed(spark, sf_dir, "events"))


@query("lateness_histogram")
def q_lateness_histogram(spark, sf_dir):
    return lateness.lateness_histogram(td.landed(spark, sf_dir, "events"))


@query("recommended_lookback")
def q_recommended_lookback(spark, sf_dir):
    return lateness.recommended_lookback(td.landed(spark, sf_dir, "events"))


@query("key_skew_topk")
def q_key_skew_topk(spark, sf_dir):
    return diagnostics.key_share_topk(td.landed(spark, sf_dir, "events"), "customer_id")


# --- slice 5: writers and replays ---------------------------------------------------
# Replays write into a fresh folder under the shared checkpoint root. A replay
# is a sequence of dependent runs, so its result is kept per session and input
# for the queries that read different tables of the same warehouse.

_REPLAYS: dict[tuple, jobs.Warehouse] = {}

CDC_RUN_BOUNDS = td.CDC_RUN_BOUNDS


def _replay(spark, sf_dir: str, family: str, lookback_days: int | None = None) -> jobs.Warehouse:
    key = (td.content_key(spark, sf_dir), family, lookback_days)
    if key in _REPLAYS:
        return _REPLAYS[key]
    wh = jobs.Warehouse(spark, scratch_dir(spark, f"replay-{family}"))
    if family == "tickets":
        wh.landing["tickets"] = td.landed(spark, sf_dir, "cdc")
        windows = jobs.boundary_windows(CDC_RUN_BOUNDS)
        jobs.backfill(wh, windows, only={"tickets"})
    elif family == "events":
        wh.landing["events"] = td.landed(spark, sf_dir, "events")
        first, last = jobs.ingest_day_range(wh.landing["events"])
        jobs.backfill(wh, jobs.day_windows(first, last), only={"events"}, lookback_days=lookback_days)
    else:
        raise ValueError(family)
    _REPLAYS[key] = wh
    return wh


def measured_lookback(spark, sf_dir: str) -> int:
    return lateness.lookback_days_value(td.landed(spark, sf_dir, "events"))


@query("bronze_day_slice")
def q_bronze_day_slice(spark, sf_dir):
    """Batch-partition replace of the whole CDC log, every run loaded twice:
    each row once, in the partition of the run that loaded it."""
    wh = jobs.Warehouse(spark, scratch_dir(spark, "bronze"))
    wh.landing["tickets"] = td.landed(spark, sf_dir, "cdc")
    for start, end in jobs.boundary_windows(CDC_RUN_BOUNDS):
        for _ in range(2):
            jobs.load_bronze(wh, "tickets", start, end)
    return wh.bronze("tickets")


@query("append_twice_counts")
def q_append_twice_counts(spark, sf_dir):
    """Plain append of the same training set twice: rows double, keys do not."""
    path = scratch_dir(spark, "append")
    src = training.training_set(silver_tickets(spark, sf_dir))
    out = None
    for run in (1, 2):
        W.append(src, path)
        snap = (spark.read.parquet(path)
                .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("ticket_id").alias("n_keys"))
                .select(F.lit(run).alias("run"), "n_rows", "n_keys"))
        snap = spark.createDataFrame(snap.collect(), snap.schema)  # a 1-row result per run
        out = snap if out is None else out.unionByName(snap)
    return out


@query("merge_training_set")
def q_merge_training_set(spark, sf_dir):
    """CDC replayed in yearly runs; Gold training set merged by ticket_id."""
    return _replay(spark, sf_dir, "tickets").training_set()


@query("backfill_equals_full")
def q_backfill_equals_full(spark, sf_dir):
    """Silver tickets after the replay equal the one-shot build."""
    return _replay(spark, sf_dir, "tickets").silver_tickets()


@query("feature_daily_incremental")
def q_feature_daily_incremental(spark, sf_dir):
    """Events replayed day by day; lookback measured from the P99 delay."""
    wh = _replay(spark, sf_dir, "events", measured_lookback(spark, sf_dir))
    return wh.feature_daily()


# --- replays of corrected landings. The first attempt dies after Bronze is overwritten; the second one repairs all. ---

def _corrected(spark, sf_dir, family: str, windows, wrong: DataFrame, right: DataFrame, replayed, **kw) -> jobs.Warehouse:
    wh = jobs.Warehouse(spark, scratch_dir(spark, f"corrected-{family}"), {family: wrong})
    jobs.backfill(wh, windows, **kw)
    wh.landing[family] = right
    for window in replayed:
        jobs.begin_run(wh, family, *window)  # died here
        jobs.run_window(wh, *window, **kw)
    return wh


def weekly_windows(spark, sf_dir) -> list[tuple]:
    import datetime as dt
    first, last = jobs.ingest_day_range(td.landed(spark, sf_dir, "events"))
    n = (last - first).days // 7
    return jobs.boundary_windows([(first + dt.timedelta(days=7 * (i + 1))).isoformat() for i in range(n)])


@query("replay_withdrawn_event")
def q_replay_withdrawn_event(spark, sf_dir):
    """First deliveries withdrawn from the first week: the deliveries of later weeks take their place."""
    events, windows = td.landed(spark, sf_dir, "events"), weekly_windows(spark, sf_dir)
    gone = (F.col("customer_id") % 40 == 7) & (F.col("_ingested_at") < F.lit(windows[0][1]).cast("timestamp_ntz"))
    return _corrected(spark, sf_dir, "events", windows, events, events.where(~gone), windows[:1]).silver_events()


@query("replay_corrected_ticket")
def q_replay_corrected_ticket(spark, sf_dir):
    """Records of the first year corrected or withdrawn: tickets go back to, or on to, the state the others give."""
    cdc, windows = td.landed(spark, sf_dir, "cdc"), jobs.boundary_windows(CDC_RUN_BOUNDS)
    early = F.col("_ingested_at") < F.lit(CDC_RUN_BOUNDS[0]).cast("timestamp_ntz")
    right = (cdc.where(~(early & (F.col("customer_id") % 17 == 3)))
                .withColumn("priority_raw", F.when(early & (F.col("customer_id") % 5 == 1), F.lit("4")).otherwise(F.col("priority_raw"))))
    return _corrected(spark, sf_dir, "tickets", windows, cdc, right.select(*cdc.columns), windows[:1]).silver_tickets()


@query("replay_emptied_day")
def q_replay_emptied_day(spark, sf_dir):
    """All events of the last day withdrawn: the day leaves Gold."""
    events, windows = td.landed(spark, sf_dir, "events"), weekly_windows(spark, sf_dir)
    day = F.to_date("event_time")
    last = events.agg(F.max(day)).first()[0]
    touched = [w for w in windows if w[1] > last.isoformat()]
    return _corrected(spark, sf_dir, "events", windows, events, events.where(day != F.lit(last)), touched,
                      lookback_days=36500).feature_daily()


@query("missing_pairs_by_day")
def q_missing_pairs_by_day(spark, sf_dir):
    """Silver (day, customer) pairs absent from a Gold built with no lookback."""
    wh = _replay(spark, sf_dir, "events", 0)
    return quality.missing_pairs_by_day(wh.silver_events(), wh.feature_daily())


@query("missing_pairs_arrival")
def q_missing_pairs_arrival(spark, sf_dir):
    """Arrival days of the Silver rows behind those missing pairs."""
    wh = _replay(spark, sf_dir, "events", 0)
    return quality.missing_pairs_arrival(wh.silver_events(), wh.feature_daily())


@query("grain_spine_gaps")
def q_grain_spine_gaps(spark, sf_dir):
    """Per day: customers in the dimension, customers present in Gold, gap."""
    ev = silver_events(spark, sf_dir)
    return quality.grain_gaps(features.feature_daily(ev), ev.select("customer_id"), "event_date", "customer_id")


# --- slice 6: joins, sampling, sources -------------------------------------------------

@query("enrich_tickets")
def q_enrich_tickets(spark, sf_dir):
    return joins.enrich(silver_tickets(spark, sf_dir), td.table(spark, sf_dir, "customer"),
                        "customer_id", "c_custkey", ["c_nationkey", "c_acctbal"])


@query("computed_key_join")
def q_computed_key_join(spark, sf_dir):
    return joins.follow_day(td.table(spark, sf_dir, "orders"))


@query("flag_join")
def q_flag_join(spark, sf_dir):
    flagged = joins.flag_from(silver_tickets(spark, sf_dir),
                              quarantine.quarantine_tickets(td.landed(spark, sf_dir, "cdc")),
                              "ticket_id", "has_bad_record")
    return flagged.select("ticket_id", "priority", "has_bad_record")


@query("semi_join_pick")
def q_semi_join_pick(spark, sf_dir):
    picked = sampling.hash_sample(silver_tickets(spark, sf_dir), "ticket_id", 500)
    return joins.restrict_to(td.landed(spark, sf_dir, "cdc"), picked, "ticket_id")


@query("range_expand")
def q_range_expand(spark, sf_dir):
    ev = silver_events(spark, sf_dir).select("event_id")
    return joins.expand_range(ev, F.col("event_id") % 4)


@query("hash_sample_n")
def q_hash_sample_n(spark, sf_dir):
    orders = td.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.hash_sample(orders, "o_orderkey", 500)


@query("disjoint_splits")
def q_disjoint_splits(spark, sf_dir):
    orders = td.table(spark, sf_dir, "orders").select("o_orderkey")
    return sampling.disjoint_splits(orders, "o_orderkey", {"train": 300, "test": 200})


@query("surrogate_ids")
def q_surrogate_ids(spark, sf_dir):
    return sampling.surrogate_ids(silver_events(spark, sf_dir).select("event_id"), "event_id")


@query("json_projection")
def q_json_projection(spark, sf_dir):
    ev = td.table(spark, sf_dir, "events").select("event_id", "props")
    return files.project_json(ev, "props", "k STRING")


@query("jsonl_roundtrip")
def q_jsonl_roundtrip(spark, sf_dir):
    """JSONL export with formatted timestamps, read back with the declared schema."""
    path = scratch_dir(spark, "jsonl")
    ev = td.landed(spark, sf_dir, "events")
    files.export_jsonl(ev, path)
    return files.read_jsonl(spark, path, ev.schema)


def raw_event_lines(spark, sf_dir) -> DataFrame:
    """Events as JSON lines; those of some users are cut short, mistyped or no object."""
    e = td.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    user = F.when(F.col("user_id") % 29 == 5, F.concat(F.lit('"u'), F.col("user_id").cast("string"), F.lit('"'))).otherwise(
        F.col("user_id").cast("string"))
    line = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"user_id":'), user,
                    F.lit(',"event_type":"'), F.col("event_type"), F.lit('"}'))
    return e.select(F.when(F.col("user_id") % 29 == 3, F.left(line, F.char_length(line) - 4))
                     .when(F.col("user_id") % 29 == 7, F.concat(F.lit("["), line, F.lit("]"))).otherwise(line).alias("value"))


@query("jsonl_malformed_split")
def q_jsonl_malformed_split(spark, sf_dir):
    """Raw lines split into records and rejects; no line is lost, no bad one stops the run."""
    path = scratch_dir(spark, "raw-lines")
    raw_event_lines(spark, sf_dir).write.text(path)
    good, bad = files.read_jsonl_split(spark, path, "event_id BIGINT, user_id BIGINT, event_type STRING")
    return good.unionByName(bad, allowMissingColumns=True)


@query("normalize_priority_sql")
def q_normalize_priority_sql(spark, sf_dir):
    """The priority rules as SQL functions, called by a statement."""
    views.register_functions(spark)
    td.landed(spark, sf_dir, "cdc").createOrReplaceTempView("raw_cdc")
    return spark.sql("select ticket_id, cdc_seq, priority_raw, normalize_priority(priority_raw) as priority, "
                     "priority_reject_reason(priority_raw) as reject_reason from raw_cdc")


# --- slice 7: layout --------------------------------------------------------------------

# --- fixed values: the dashboard's point lookup ---
DASHBOARD_CUSTOMER = "Customer#000000008"
DASHBOARD_DAY = "2024-01-02"
DASHBOARD_COLUMNS = ["event_id", "ticket_id", "customer_id", "customer_name", "segment", "event_type",
                     "model", "latency_ms", "tokens_in", "tokens_out", "is_escalated", "event_time", "event_date"]
_LAYOUTS: dict[tuple, tuple[str, dict]] = {}


def compacted(spark, sf_dir: str) -> tuple[str, dict]:
    """Dashboard dataset compacted by day, sorted by customer and time."""
    key = td.content_key(spark, sf_dir)
    if key not in _LAYOUTS:
        path = scratch_dir(spark, "compacted")
        report = layout.compact(silver_events(spark, sf_dir).select(*DASHBOARD_COLUMNS), path,
                                "event_date", ["customer_name", "event_time"], bloom_cols=["customer_name"])
        _LAYOUTS[key] = (path, report)
    return _LAYOUTS[key]


def dashboard_lookup(data):
    hit = data.where((F.col("customer_name") == DASHBOARD_CUSTOMER)
                     & (F.col("event_date") == F.lit(DASHBOARD_DAY).cast("date")))
    return features.dashboard_tile(hit)


def dashboard_lookup_wrapped(data):
    """The same question with the day as a wrapped expression (no pruning)."""
    hit = data.where((F.col("customer_name") == DASHBOARD_CUSTOMER)
                     & tf.on_day_wrapped("event_time", DASHBOARD_DAY))
    return features.dashboard_tile(hit)


@query("compact_events")
def q_compact_events(spark, sf_dir):
    path, _ = compacted(spark, sf_dir)
    return spark.read.parquet(path).select(*DASHBOARD_COLUMNS)


@query("compaction_row_parity")
def q_compaction_row_parity(spark, sf_dir):
    """Rows of the source and of the compacted files, both counted by Spark."""
    after = spark.read.parquet(compacted(spark, sf_dir)[0])

    def n(df):
        return df.agg(F.count(F.lit(1))).scalar()

    return (spark.range(1).select(n(silver_events(spark, sf_dir)).alias("rows_before"), n(after).alias("rows_after"))
            .withColumn("same", F.col("rows_before") == F.col("rows_after")))


@query("dashboard_point_lookup")
def q_dashboard_point_lookup(spark, sf_dir):
    path, _ = compacted(spark, sf_dir)
    return dashboard_lookup(spark.read.parquet(path))


@query("day_filter_equivalence")
def q_day_filter_equivalence(spark, sf_dir):
    """One day counted three ways: wrapped expression, bare-column range,
    partition column. All three must agree; only the last two prune."""
    data = spark.read.parquet(compacted(spark, sf_dir)[0])

    def n(cond):
        return data.where(cond).agg(F.count(F.lit(1))).scalar()

    return spark.range(1).select(
        F.lit(DASHBOARD_DAY).cast("date").alias("day"),
        n(tf.on_day_wrapped("event_time", DASHBOARD_DAY)).alias("n_wrapped"),
        n(tf.day_slice("event_time", DASHBOARD_DAY)).alias("n_sargable"),
        n(F.col("event_date") == F.lit(DASHBOARD_DAY).cast("date")).alias("n_partition"),
    ).withColumn("same", (F.col("n_wrapped") == F.col("n_sargable")) & (F.col("n_sargable") == F.col("n_partition")))


def _layouts(spark, sf_dir) -> tuple[dict, dict]:
    """Scan reports of the dashboard lookup before (many unpartitioned files,
    wrapped day filter) and after compaction (partition + sorted row groups)."""
    before_path = scratch_dir(spark, "small-files")
    (silver_events(spark, sf_dir).select(*DASHBOARD_COLUMNS).repartition(200)
     .write.mode("overwrite").parquet(before_path))
    return (layout.scan_report(spark, "before", before_path, dashboard_lookup_wrapped),
            layout.scan_report(spark, "after", compacted(spark, sf_dir)[0], dashboard_lookup))


@query("layout_report")
def q_layout_report(spark, sf_dir):
    """Per layout: rows on disk by its footers, the dashboard's result, and whether results agree, the scan effort is
    accepted, and the scan read no more rows than the footers' zone map predicts."""
    before, after = _layouts(spark, sf_dir)
    verdict = layout.accept(before, after)
    out = None
    for r in (before, after):
        zones = layout.zone_map(spark, r["path"], ["customer_name"])
        where = {"event_date": DASHBOARD_DAY} if r["layout"] == "after" else {}
        hit = layout.predicted(zones, {"customer_name": DASHBOARD_CUSTOMER}, where)
        rows = zones.agg(F.sum("rows")).scalar()
        row = (dashboard_lookup(spark.read.parquet(r["path"])).select(
            F.lit(r["layout"]).alias("layout"), rows.alias("rows_on_disk"), "customer_name", "n_events", "tokens_total",
            F.lit(verdict["same_result"]).alias("same_result"), F.lit(verdict["ok"]).alias("accepted"),
            (hit.agg(F.sum("rows")).scalar() >= F.lit(r["rows_scanned"])).alias("within_prediction")))
        out = row if out is None else out.unionByName(row)
    return out


@query("layout_scan_effort")
def q_layout_scan_effort(spark, sf_dir):
    """The scan figures behind ``layout_report``: files and rows read of those on disk."""
    before, after = _layouts(spark, sf_dir)
    verdict = layout.accept(before, after)
    rows = [{k: v for k, v in {**r, **verdict}.items() if k != "path"} for r in (before, after)]
    return spark.createDataFrame(rows)


@query("dashboard_absent_key")
def q_dashboard_absent_key(spark, sf_dir):
    """A customer that no row has, though its name lies inside the files' min/max: the Bloom filters of the compacted
    files skip every row group."""
    absent = f"{DASHBOARD_CUSTOMER}~"
    hit = spark.read.parquet(compacted(spark, sf_dir)[0]).where(F.col("customer_name") == absent)
    rows = hit.agg(F.count(F.lit(1)).alias("n_events"))
    got = rows.collect()
    inside = layout.predicted(layout.zone_map(spark, compacted(spark, sf_dir)[0], ["customer_name"]), {"customer_name": absent})
    return inside.agg((F.count(F.lit(1)) > 0).alias("inside_min_max")).select(
        F.lit(absent).alias("customer_name"), "inside_min_max", F.lit(got[0]["n_events"]).cast("long").alias("n_events"),
        F.lit(layout.scan_metrics(rows)["rows_scanned"]).cast("long").alias("rows_scanned"))


# --- slice 8: streaming ---------------------------------------------------------------

# --- fixed values: the topic is published as this many files, consumed two per batch ---
LOG_FILES = 20
LOG_ORDER = ["_ingested_at", "event_id", "latency_ms"]
_LOGS: dict[tuple, str] = {}


def event_log(spark, sf_dir: str) -> str:
    key = td.content_key(spark, sf_dir)
    if key not in _LOGS:
        path = scratch_dir(spark, "topic-events")
        ingest.publish_log(td.landed(spark, sf_dir, "events"), path, LOG_FILES, LOG_ORDER)
        _LOGS[key] = path
    return _LOGS[key]


def _drain(spark, sf_dir: str, keep: str = "last", guarded: bool = True):
    log = event_log(spark, sf_dir)
    schema = spark.read.parquet(log).schema
    table = ingest.stream_table(spark, scratch_dir(spark, "stream"), keep=keep, guarded=guarded)
    ingest.consume(spark, log, schema, table, scratch_dir(spark, "stream-ckpt"))
    return table


@query("stream_upsert_latest")
def q_stream_upsert_latest(spark, sf_dir):
    """Topic drained in micro-batches; a re-delivered event replaces the stored one."""
    return _drain(spark, sf_dir).read().select(*ingest.STREAM_COLUMNS)


@query("stream_upsert_incoming_wins")
def q_stream_upsert_incoming_wins(spark, sf_dir):
    """Unconditional DO UPDATE: the message consumed last is stored. The topic is
    consumed in arrival order, so per event that is the last arrival."""
    return _drain(spark, sf_dir, guarded=False).read().select(*ingest.STREAM_COLUMNS)


@query("stream_first_wins")
def q_stream_first_wins(spark, sf_dir):
    """Same topic; the first delivery of each event is kept."""
    return _drain(spark, sf_dir, "first").read().select(*ingest.STREAM_COLUMNS)


@query("stream_restart_parity")
def q_stream_restart_parity(spark, sf_dir):
    """A consumer that lost its offsets starts over on a new checkpoint and the
    same table: rows = distinct ids = distinct ids of the topic."""
    table = _drain(spark, sf_dir)
    log = event_log(spark, sf_dir)
    again = ingest.consume(spark, log, spark.read.parquet(log).schema, table, scratch_dir(spark, "restart-ckpt"))
    return (table.read().agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_ids"))
            .withColumn("restarted", F.lit(len(again) > 0)))


@query("log_head")
def q_log_head(spark, sf_dir):
    """The first 500 messages of the topic in offset (arrival) order."""
    ev = td.landed(spark, sf_dir, "events").select(*ingest.STREAM_COLUMNS)
    return ev.orderBy(*LOG_ORDER).limit(500)


# --- slice 9: quality, reconciliation, checksums ---------------------------------------

def one_shot_tables(spark, sf_dir: str) -> dict:
    """Every layer built in one pass from the fixtures (no replay)."""
    cdc = td.landed(spark, sf_dir, "cdc")
    ev = td.landed(spark, sf_dir, "events")
    tr = td.landed(spark, sf_dir, "transcripts")
    s_tickets = latest.silver_tickets(cdc)
    s_events = latest.silver_events(ev)
    s_trans = latest.silver_transcripts(tr)
    return {
        "bronze_tickets": cdc, "bronze_events": ev, "bronze_transcripts": tr,
        "silver_tickets": s_tickets, "quarantine_tickets": quarantine.quarantine_tickets(cdc),
        "silver_events": s_events, "silver_transcripts": s_trans,
        "gold_training_set": training.training_set(s_tickets),
        "gold_feature_daily": features.feature_daily(s_events),
        "gold_doc_chunks": chunks.doc_chunks(s_trans),
    }


CHECKSUM_TABLES = ["gold_training_set", "gold_feature_daily", "gold_doc_chunks", "quarantine_tickets"]


@query("dq_report")
def q_dq_report(spark, sf_dir):
    t = one_shot_tables(spark, sf_dir)
    return quality.run_checks(t, quality.DEFAULT_CHECKS)


@query("dq_domain_violations")
def q_dq_domain_violations(spark, sf_dir):
    return quality.domain_violations(silver_tickets(spark, sf_dir))


@query("count_reconciliation")
def q_count_reconciliation(spark, sf_dir):
    return _reconciliation(spark, one_shot_tables(spark, sf_dir))


def _reconciliation(spark, t: dict) -> DataFrame:
    """Every table is counted in one pass, all in one plan."""
    n = F.count(F.lit(1))
    tagged = quarantine.tag(t["bronze_tickets"])
    counts = quality.table_counts([
        (tagged, {"records": n, "accepted": F.count_if(F.col("_priority").isNotNull())}),
        (t["quarantine_tickets"], {"quarantined": n}),
        (t["bronze_events"], {"event_ids": F.count_distinct("event_id")}),
        (t["silver_events"], {"silver_events": n, "day_customers": F.count_distinct("event_date", "customer_id")}),
        (t["gold_feature_daily"], {"feature_rows": n}), (t["silver_tickets"], {"silver_tickets": n}),
        (t["gold_training_set"], {"training_rows": n}), (t["gold_doc_chunks"], {"chunks": n}),
        (t["silver_transcripts"], {"turns": F.sum(F.size("turns"))})])
    return quality.reconcile_counts(counts, [
        ("accepted + quarantined = bronze records", ["accepted", "quarantined"], "records"),
        ("silver_events = distinct bronze event ids", ["silver_events"], "event_ids"),
        ("gold_feature_daily = distinct silver (day, customer)", ["feature_rows"], "day_customers"),
        ("gold_training_set = silver_tickets", ["training_rows"], "silver_tickets"),
        ("gold_doc_chunks = turns of silver transcripts", ["chunks"], "turns"),
    ])


def dirty_tables(spark, sf_dir: str) -> dict:
    """The tables with what the checks are there to find: repeated and lost keys, values out of the domain, lost rows."""
    t = one_shot_tables(spark, sf_dir)
    key = F.col("ticket_id")
    tickets = t["silver_tickets"].unionByName(t["silver_tickets"].where(key % 50 == 7))
    priority = F.when(key % 31 == 4, F.lit(9)).when(key % 37 == 5, F.lit(None)).otherwise(F.col("priority")).cast("int")
    events = t["silver_events"].withColumn("event_id", F.when(F.col("event_id") % 97 != 11, F.col("event_id")))
    chunks_ = t["gold_doc_chunks"]
    return {**t, "silver_tickets": tickets.withColumn("priority", priority),
            "silver_events": events.withColumn("event_time", F.when(F.col("customer_id") % 41 != 3, F.col("event_time"))),
            "quarantine_tickets": t["quarantine_tickets"].withColumn("reject_reason", F.when(key % 3 != 1, F.col("reject_reason"))),
            "gold_training_set": t["gold_training_set"].unionByName(t["gold_training_set"].where(key % 60 == 1)),
            "gold_doc_chunks": chunks_.where("chunk_index < 3").unionByName(chunks_.where("transcript_id % 20 = 5"))}


@query("dq_report_dirty")
def q_dq_report_dirty(spark, sf_dir):
    """The column tests on tables that violate them."""
    return quality.run_checks(dirty_tables(spark, sf_dir), quality.DEFAULT_CHECKS)


@query("dq_domain_violations_dirty")
def q_dq_domain_violations_dirty(spark, sf_dir):
    return quality.domain_violations(dirty_tables(spark, sf_dir)["silver_tickets"])


@query("count_reconciliation_dirty")
def q_count_reconciliation_dirty(spark, sf_dir):
    return _reconciliation(spark, dirty_tables(spark, sf_dir))


@query("table_checksum")
def q_table_checksum(spark, sf_dir):
    t = one_shot_tables(spark, sf_dir)
    return quality.table_checksums({k: t[k] for k in CHECKSUM_TABLES})


@query("row_counts")
def q_row_counts(spark, sf_dir):
    """Rows per layer; one pass over each Bronze source."""
    return quality.layer_counts(*[td.landed(spark, sf_dir, n) for n in ("cdc", "events", "transcripts")])


def stability_windows(spark, landing: dict) -> list[tuple]:
    """Yearly runs over the CDC years, then weekly runs over the event and
    transcript weeks (every run is a whole-pipeline run)."""
    import datetime as dt
    last = max(jobs.ingest_day_range(df)[1] for k, df in landing.items() if k != "tickets")
    start = dt.date(2024, 1, 1)
    weeks = []
    while start <= last:
        weeks.append(start.isoformat())
        start += dt.timedelta(days=7)
    return jobs.boundary_windows(CDC_RUN_BOUNDS + weeks)


@query("rerun_stability")
def q_rerun_stability(spark, sf_dir):
    """The whole replay run three times on one warehouse; Gold checksums after
    each replay must be equal (and equal to the one-shot build)."""
    wh = jobs.Warehouse(spark, scratch_dir(spark, "rerun"))
    wh.landing["tickets"] = td.landed(spark, sf_dir, "cdc")
    wh.landing["events"] = td.landed(spark, sf_dir, "events")
    wh.landing["transcripts"] = td.landed(spark, sf_dir, "transcripts")
    windows = stability_windows(spark, wh.landing)
    lookback = measured_lookback(spark, sf_dir)
    snaps = None
    for run in (1, 2, 3):
        jobs.backfill(wh, windows, lookback_days=lookback)
        tables = {"gold_training_set": wh.training_set(), "gold_feature_daily": wh.feature_daily(),
                  "gold_doc_chunks": wh.doc_chunks(), "quarantine_tickets": wh.quarantine()}
        snap = quality.table_checksums(tables).select(F.lit(run).alias("run"), "*")
        snap = spark.createDataFrame(snap.collect(), snap.schema)  # freeze this run's numbers
        snaps = snap if snaps is None else snaps.unionByName(snap)
    return snaps


def _deduplicated(spark, sf_dir):
    log = event_log(spark, sf_dir)
    table = ingest.stream_table(spark, scratch_dir(spark, "stream-dedup"), keep="first")
    ingest.dedup_arrivals(spark, log, spark.read.parquet(log).schema, table, scratch_dir(spark, "dedup-ckpt"),
                          "event_time", "_ingested_at", 2, ["event_id", "event_time", "_ingested_at"])
    return table.read()


@query("stream_dedup_watermark")
def q_stream_dedup_watermark(spark, sf_dir):
    """Topic de-duplicated by event id: every event exactly once, late ones included."""
    return _deduplicated(spark, sf_dir).select("event_id", F.to_date("event_time").alias("event_date"))


@query("stream_dedup_state")
def q_stream_dedup_state(spark, sf_dir):
    """Topic de-duplicated in the state store, late rows in a side output: every event once, marked late or not."""
    log, root = event_log(spark, sf_dir), scratch_dir(spark, "stream-state")
    ingest.dedup_in_state(spark, log, spark.read.parquet(log).schema, root, scratch_dir(spark, "state-ckpt"), "event_id",
                          "event_time", "_ingested_at", 2, ["event_id", "event_time", "_ingested_at"])
    return ingest.deduplicated(spark, root, "event_id", "_ingested_at").select(
        "event_id", F.to_date("event_time").alias("event_date"), "late")


@query("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """Rows that arrived over two days late, accounted for beside the others."""
    return _deduplicated(spark, sf_dir).groupBy("late").agg(F.count(F.lit(1)).alias("n_events"))


def replays_are_stable(spark, sf_dir) -> DataFrame:
    """One row: do the Gold checksums of two replays of everything equal those of the one-shot build?"""
    wh = jobs.Warehouse(spark, scratch_dir(spark, "stable"), {"tickets": td.landed(spark, sf_dir, "cdc"), "events": td.landed(
        spark, sf_dir, "events"), "transcripts": td.landed(spark, sf_dir, "transcripts")})
    t = one_shot_tables(spark, sf_dir)
    sums = quality.table_checksums({k: t[k] for k in CHECKSUM_TABLES}).select(F.lit(0).alias("run"), "*")
    for run in (1, 2):
        jobs.backfill(wh, jobs.boundary_windows([CDC_RUN_BOUNDS[2], "2024-01-08"]), lookback_days=36500)
        snap = quality.table_checksums({"gold_training_set": wh.training_set(), "gold_feature_daily": wh.feature_daily(),
                                        "gold_doc_chunks": wh.doc_chunks(), "quarantine_tickets": wh.quarantine()})
        snap = snap.select(F.lit(run).alias("run"), "*")
        sums = sums.unionByName(spark.createDataFrame(snap.collect(), snap.schema))  # freeze this run's numbers
    per_table = sums.where("table_name <> 'gold_training_set' or run > 0").groupBy("table_name").agg(
        F.count_distinct("checksum", "n_rows").alias("n"))
    return per_table.agg((F.max("n") == 1).alias("ok"))


@query("acceptance_summary")
def q_acceptance_summary(spark, sf_dir):
    """The pipeline's acceptance criteria, one row each."""
    parts = [
        ("replays are stable", replays_are_stable(spark, sf_dir)),
        ("column tests pass", q_dq_report(spark, sf_dir).agg(F.bool_and("ok"))),
        ("layer counts reconcile", q_count_reconciliation(spark, sf_dir).agg(F.bool_and("ok"))),
        ("accept/reject is a partition", q_split_reconciliation(spark, sf_dir).agg(F.bool_and("ok"))),
        ("priority domain holds", q_dq_domain_violations(spark, sf_dir).agg(F.count(F.lit(1)) == 0)),
    ]
    out = None
    for name, df in parts:
        row = spark.range(1).select(F.lit(name).alias("criterion"), df.scalar().alias("ok"))
        out = row if out is None else out.unionByName(row)
    return out


@query("feature_daily_skewed")
def q_feature_daily_skewed(spark, sf_dir):
    """Daily features with one customer holding a third of all events: the first
    exchange is keyed by ticket as well, which spreads the hot customer, and its p95 is found by counting."""
    return features.feature_daily_any_size(latest.silver_events(td.landed(spark, sf_dir, "events_skewed")))


@query("missing_pairs_skewed")
def q_missing_pairs_skewed(spark, sf_dir):
    """Silver pairs missing from a fresh view built from rows that arrived
    within an hour; the hot customer's rows form the skewed side of the
    anti join (AQE splits a skewed partition; a small Gold side is broadcast)."""
    ev = latest.silver_events(td.landed(spark, sf_dir, "events_skewed"))
    gold = features.feature_daily(ev.where(F.col("_ingested_at") < F.expr("event_time + interval 1 hour")))
    return quality.missing_pairs_by_day(ev, gold)


@query("layout_files")
def q_layout_files(spark, sf_dir):
    """Rows and customer range per day folder of the compacted layout, from the files' footers and by file metadata."""
    path, _ = compacted(spark, sf_dir)
    zones = layout.zone_map(spark, path, ["customer_name"])
    day = F.regexp_extract("file", "event_date=([0-9-]+)", 1).cast("date")
    footers = zones.groupBy(day.alias("event_date")).agg(F.sum("rows").alias("rows"), F.min("low").alias("first_customer"),
                                                         F.max("high").alias("last_customer"))
    listed = files.file_report(spark.read.parquet(path)).groupBy(
        F.regexp_extract("file_path", "event_date=([0-9-]+)", 1).cast("date").alias("event_date")).agg(F.sum("rows").alias("rows_read"))
    return footers.join(listed, "event_date")


# --- SQL access ---------------------------------------------------------------------------

# The dashboard statement as a user writes it against a dataset registered by
# name; day folder and customer are bare columns, so both filters prune.
DASHBOARD_SQL = """
select customer_name,
       count(*)                                                    as n_events,
       count(distinct ticket_id)                                   as n_tickets,
       round(avg(latency_ms) * 10, 0) / 10                         as avg_latency_ms,
       cast(bround(round(percentile(latency_ms, 0.95), 6), 0) as int) as p95_latency_ms,
       count_if(is_escalated)                                      as n_escalated,
       sum(cast(tokens_in as bigint) + tokens_out)                 as tokens_total
from dashboard_events
where customer_name = 'Customer#000000008' and event_date = date '2024-01-02'
group by customer_name
"""


@query("dashboard_sql")
def q_dashboard_sql(spark, sf_dir):
    """The dashboard lookup through spark.sql over the compacted dataset."""
    views.register_dataset(spark, "dashboard_events", compacted(spark, sf_dir)[0])
    return spark.sql(DASHBOARD_SQL)


@query("gold_rows_vs_keys_sql")
def q_gold_rows_vs_keys_sql(spark, sf_dir):
    """Rows vs distinct keys of the replayed Gold training set, via spark.sql
    over the warehouse views (a merged table holds one row per key)."""
    views.register_views(_replay(spark, sf_dir, "tickets"))
    return spark.sql("select count(*) as n_rows, count(distinct ticket_id) as n_keys from gold_training_set")


@query("stream_jsonl_upsert")
def q_stream_jsonl_upsert(spark, sf_dir):
    """The topic as JSON-lines segments (declared schema, strict parsing),
    drained with the replay-safe upsert: same table as the Parquet topic."""
    path = scratch_dir(spark, "topic-jsonl")
    events = td.landed(spark, sf_dir, "events")
    ingest.publish_log(events, path, LOG_FILES, LOG_ORDER, fmt="json")
    table = ingest.stream_table(spark, scratch_dir(spark, "stream-jsonl"))
    ingest.consume(spark, path, events.schema, table, scratch_dir(spark, "jsonl-ckpt"), fmt="json")
    return table.read().select(*ingest.STREAM_COLUMNS)
