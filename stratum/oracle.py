"""DuckDB SQL twins of the registered queries.

Each statement reads the raw test tables (``events``, ``orders``,
``customer``, ``conversations`` ...) and rebuilds the same fixtures as
``stratum.sources.testdata`` in CTEs, then computes the answer in one
declarative statement. Column names and types match the Spark side.
"""

from __future__ import annotations

# --- shared CTEs: name -> (dependencies, body) ---------------------------------
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body.strip())


_cte("fx_events", (), """
select event_id, event_id % 997 as ticket_id, user_id as customer_id, c_name as customer_name, c_mktsegment as segment,
       event_type, 'm' || (cast(props ->> '$.k' as integer) % 4) as model, latency_ms,
       cast(length(event_type) * 30 + user_id % 60 as integer) as tokens_in,
       cast(length(props) * 4 as integer) as tokens_out,
       event_type = 'error' as is_escalated, ts as event_time, ts + to_seconds(delay) as _ingested_at
from (select *, cast(floor(value * 10) as integer) as latency_ms,
             cast(floor(case when value > 150 then value * 600 else value * 60 end) as bigint) as delay
      from events
      union all
      select *, cast(floor(value * 10) as integer) + 1, cast(floor(value * 20) as bigint) + 300000
      from events where user_id % 40 = 7)
left join customer on c_custkey = user_id
""")

_cte("silver_events", ("fx_events",), """
select event_id, ticket_id, customer_id, customer_name, segment, event_type, model, latency_ms,
       tokens_in, tokens_out, is_escalated, event_time, _ingested_at,
       cast(event_time as date) as event_date, cast(_ingested_at as date) as ingested_date
from fx_events
qualify row_number() over (partition by event_id order by _ingested_at, latency_ms) = 1
""")

_cte("cdc_base", (), """
select o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
       cast(floor(o_totalprice) as bigint) as price,
       o_orderdate + to_seconds(cast(floor(o_totalprice) as bigint) % 80000) as t0,
       least(cast(substr(o_orderpriority, 1, 1) as integer), 4) as pcode
from orders
""")

_cte("cdc_ops", ("cdc_base",), """
select *, 'c' as op, 0 as cdc_seq, t0 as event_time, false as is_bad from cdc_base
union all
select *, 'd', 1, t0 + to_seconds(21600), false from cdc_base where o_orderstatus = 'F' and o_custkey % 17 = 3
union all
select *, 'u', 2, t0 + to_seconds(pcode * 86400), o_custkey % 4 = 1
from cdc_base where o_orderstatus = 'O' and o_custkey % 3 = 0
""")

_cte("fx_cdc", ("cdc_ops",), """
select op, o_orderkey as ticket_id, cdc_seq, event_time, event_time as _ingested_at,
       o_custkey as customer_id, c_name as customer_name, c_mktsegment as segment,
       case when is_bad then
                 case o_orderkey % 8
                      when 0 then null when 1 then '' when 2 then '  ' when 3 then '7'
                      when 4 then '-2' when 5 then '40' when 6 then 'soon' else '3rd' end
            when event_time >= timestamp '1998-01-01 00:00:00' then
                 case pcode when 1 then 'urgent' when 2 then 'high' when 3 then 'medium' else 'low' end
            else cast(pcode as varchar) end as priority_raw,
       o_orderpriority as category,
       o_orderstatus as channel,
       case when op = 'd' then 'closed' when op = 'c' then 'open'
            else case pcode when 1 then 'open' when 2 then 'pending' when 3 then 'resolved' else 'closed' end
       end as status,
       pcode + 1 as csat,
       cast(price % 3600 as integer) as first_response_sec,
       'Order ' || cast(o_orderkey as varchar) as subject,
       o_orderpriority || ' / ' || o_orderstatus as body
from cdc_ops join customer on c_custkey = o_custkey
""")

# Priority rule. Integers only (optional sign, digits, blanks around): DuckDB's
# try_cast would also take '3.7' or '1e0', Spark's does not.
PRIO_INT = ("(case when regexp_full_match(priority_raw, ' *[+-]?[0-9]+ *') "
            "then try_cast(trim(priority_raw) as integer) end)")
PRIO_NORM = f"""(case when {PRIO_INT} between 1 and 4 then {PRIO_INT}
      when lower(trim(priority_raw)) = 'urgent' then 1
      when lower(trim(priority_raw)) = 'high' then 2
      when lower(trim(priority_raw)) = 'medium' then 3
      when lower(trim(priority_raw)) = 'low' then 4 end)"""
PRIO_REASON = f"""(case when {PRIO_NORM} is not null then null
      when priority_raw is null then 'priority NULL'
      when trim(priority_raw) = '' then 'priority empty'
      when {PRIO_INT} is not null then 'priority is a number outside 1..4'
      else 'priority is an unknown string, not in the label map' end)"""

_cte("cdc_norm", ("fx_cdc",), f"select *, {PRIO_NORM} as _priority from fx_cdc")

_cte("silver_tickets", ("cdc_norm",), """
select ticket_id, customer_id, customer_name, segment, _priority as priority, category, channel,
       status, csat, first_response_sec, subject, body, event_time as updated_at, _ingested_at
from (select * from cdc_norm where _priority is not null
      qualify row_number() over (partition by ticket_id order by event_time desc, cdc_seq desc) = 1)
where op <> 'd'
""")

_cte("quarantine_tickets", ("cdc_norm",), f"""
select ticket_id, cdc_seq, op, event_time, _ingested_at, priority_raw,
       {PRIO_REASON} as reject_reason, customer_id, customer_name, category, status
from cdc_norm where _priority is null
""")

_cte("training_set", ("silver_tickets",), """
select ticket_id, customer_id, customer_name, segment, priority, category, channel, status, csat,
       first_response_sec, cast(length(subject) + length(body) as integer) as text_len,
       case when status in ('resolved', 'closed') then 1 else 0 end as label_resolved,
       updated_at, _ingested_at
from silver_tickets
""")

_cte("conv_turns", (), """
select conv_id, list(text order by turn) as turns from conversations group by conv_id
""")

_cte("fx_transcripts", ("conv_turns",), """
select conv_id as transcript_id, conv_id % 997 as ticket_id,
       case conv_id % 4 when 0 then 'en' when 1 then 'fr' when 2 then 'de' else 'es' end as lang,
       turns, timestamp '2024-01-01 00:00:00' + to_seconds(conv_id * 3600) as event_time,
       timestamp '2024-01-01 00:00:00' + to_seconds(conv_id * 3600 + (conv_id % 7) * 60) as _ingested_at
from conv_turns
union all
select conv_id, conv_id % 997,
       case conv_id % 4 when 0 then 'en' when 1 then 'fr' when 2 then 'de' else 'es' end,
       turns, timestamp '2024-01-01 00:00:00' + to_seconds(conv_id * 3600),
       timestamp '2024-01-01 00:00:00' + to_seconds(conv_id * 3600 + 7200 + conv_id % 7)
from conv_turns where conv_id % 10 = 3
""")

_cte("silver_transcripts", ("fx_transcripts",), """
select transcript_id, ticket_id, lang, turns, event_time, _ingested_at from fx_transcripts
qualify row_number() over (partition by transcript_id order by _ingested_at) = 1
""")

_cte("doc_chunks", ("silver_transcripts",), """
select cast(transcript_id as varchar) || '#' || cast(i - 1 as varchar) as chunk_id,
       transcript_id, ticket_id, lang, cast(i - 1 as integer) as chunk_index,
       turns[i] as chunk_text, cast(length(turns[i]) as integer) as n_chars, event_time
from silver_transcripts, unnest(range(1, len(turns) + 1)) as r(i)
""")

FEATURE_AGGS = """
       count(*) as n_events, count(distinct ticket_id) as n_tickets,
       cast(sum(case when is_escalated then 1 else 0 end) as bigint) as n_escalated,
       round(avg(latency_ms) * 100, 0) / 100 as avg_latency_ms,
       cast(round_even(round(quantile_cont(latency_ms, 0.95), 6), 0) as integer) as p95_latency_ms,
       cast(sum(tokens_in) as bigint) as tokens_in, cast(sum(tokens_out) as bigint) as tokens_out"""

_cte("feature_daily", ("silver_events",), f"""
select event_date, customer_id, customer_name, segment,{FEATURE_AGGS}
from silver_events group by event_date, customer_id, customer_name, segment
""")


def _order(names: tuple[str, ...] | list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in CTES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(body: str, *needs: str) -> str:
    names = _order(needs)
    if not names:
        return body.strip()
    parts = ",\n".join(f"{n} as (\n{CTES[n][1]}\n)" for n in names)
    return f"with {parts}\n{body.strip()}"


# --- the statements ------------------------------------------------------------
SQL: dict[str, str] = {}


def register(key: str, body: str, *needs: str) -> None:
    SQL[key] = with_ctes(body, *needs)


register("silver_events", "select * from silver_events", "silver_events")
register("feature_daily_full", "select * from feature_daily", "feature_daily")

# slice 2: CDC
register("silver_tickets", "select * from silver_tickets", "silver_tickets")
register("quarantine_tickets", "select * from quarantine_tickets", "quarantine_tickets")
register("split_reconciliation", """
select n_all, n_accepted, n_rejected, n_both,
       (n_accepted + n_rejected = n_all) and n_both = 0 as ok
from (select count(*) as n_all,
             count(*) filter (where _priority is not null) as n_accepted,
             count(*) filter (where _priority is null) as n_rejected,
             (select count(*) from cdc_norm a
               where a._priority is not null
                 and exists (select 1 from cdc_norm b where b._priority is null
                              and b.ticket_id = a.ticket_id and b.cdc_seq = a.cdc_seq)) as n_both
      from cdc_norm)
""", "cdc_norm")
register("rank_then_filter_loss", """
select n_filter_then_rank, n_rank_then_filter, n_filter_then_rank - n_rank_then_filter as n_lost
from (select (select count(*) from silver_tickets) as n_filter_then_rank,
             (select count(*) from (select * from cdc_norm
                  qualify row_number() over (partition by ticket_id order by event_time desc, cdc_seq desc) = 1)
               where _priority is not null and op <> 'd') as n_rank_then_filter)
""", "silver_tickets", "cdc_norm")
register("normalize_priority",
         "select ticket_id, cdc_seq, priority_raw, _priority as priority from cdc_norm", "cdc_norm")
register("reject_reasons",
         "select reject_reason, count(*) as n from quarantine_tickets group by reject_reason",
         "quarantine_tickets")
register("value_distribution", """
select priority_raw, count(*) as n from fx_cdc group by priority_raw order by priority_raw nulls last
""", "fx_cdc")
register("schema_change_by_day", f"""
select cast(event_time as date) as day, count(*) filter (where {PRIO_INT} is null) as n_non_numeric,
       count(*) as n
from fx_cdc group by 1
""", "fx_cdc")
register("cdc_op_counts", "select op, count(*) as n from fx_cdc group by op order by op", "fx_cdc")
register("cdc_union", "select * from fx_cdc", "fx_cdc")
register("duplicate_keys", """
select ticket_id, count(*) as n from fx_cdc group by ticket_id having count(*) > 1
order by n desc, ticket_id limit 10
""", "fx_cdc")
register("rows_vs_distinct",
         "select count(*) as n_rows, count(distinct ticket_id) as n_keys from fx_cdc", "fx_cdc")
register("training_set", "select * from training_set", "training_set")

# slice 3: transcripts
register("silver_transcripts", "select * from silver_transcripts", "silver_transcripts")
register("transcripts_from_turns", "select conv_id, turns from conv_turns", "conv_turns")
register("doc_chunks", "select * from doc_chunks", "doc_chunks")

# slice 4: lateness and skew
_cte("lateness_profile", ("fx_events",), """
select round(q[1] / 86400.0 * 1e6, 0) / 1e6 as p50_days,
       round(q[2] / 86400.0 * 1e6, 0) / 1e6 as p95_days,
       round(q[3] / 86400.0 * 1e6, 0) / 1e6 as p99_days,
       round(mx / 86400.0 * 1e6, 0) / 1e6 as max_days,
       round(late * 1e6, 0) / 1e6 as late_ratio
from (select quantile_cont(d, [0.5, 0.95, 0.99]) as q, max(d) as mx,
             avg(case when _ingested_at > event_time + interval 1 day then 1.0::double else 0.0::double end) as late
      from (select *, date_diff('second', event_time, _ingested_at) as d from fx_events))
""")
register("lateness_profile", "select * from lateness_profile", "lateness_profile")
register("lateness_histogram", """
select date_diff('hour', event_time, _ingested_at) as delay_hours, count(*) as n
from fx_events group by 1 order by 1
""", "fx_events")
register("recommended_lookback", """
select p99_days, max_days, cast(ceil(p99_days) as integer) as lookback_days from lateness_profile
""", "lateness_profile")
register("key_skew_topk", """
select customer_id, count(*) as n,
       round(count(*) / (select count(*) from fx_events)::double * 1e6, 0) / 1e6 as share
from fx_events group by customer_id order by n desc, customer_id limit 10
""", "fx_events")

# slice 5: writers and replays ----------------------------------------------------------
from stratum.sources.testdata import CDC_RUN_BOUNDS  # noqa: E402


def _batch_of(ts: str, bounds: list[str], as_date: bool) -> str:
    """SQL CASE giving the run (window) of a timestamp: its index, or the
    window start date as ``_batch_date``."""
    starts = ["1900-01-01"] + bounds
    parts = []
    for i, b in enumerate(bounds):
        val = f"date '{starts[i]}'" if as_date else str(i)
        parts.append(f"when {ts} < timestamp '{b} 00:00:00' then {val}")
    last = f"date '{starts[-1]}'" if as_date else str(len(bounds))
    return "(case " + " ".join(parts) + f" else {last} end)"


register("bronze_day_slice",
         f"select *, {_batch_of('_ingested_at', CDC_RUN_BOUNDS, True)} as _batch_date from fx_cdc",
         "fx_cdc")
register("append_twice_counts", """
select run, n_rows * run as n_rows, n_keys
from (select count(*) as n_rows, count(distinct ticket_id) as n_keys from training_set),
     (select 1 as run union all select 2)
""", "training_set")

# Merge by key over yearly runs, closed form: a valid record is emitted by the
# run of its batch when it is the newest valid record of its ticket among all
# batches so far and not a tombstone; the last emission per ticket stays
# (a merge never deletes).
_cte("merge_replay", ("cdc_norm",), f"""
select * from (
    select *, max(k) over (partition by ticket_id order by b
                           range between unbounded preceding and current row) as kmax
    from (select *, {_batch_of('_ingested_at', CDC_RUN_BOUNDS, False)} as b,
                 epoch_us(event_time) * 10 + cdc_seq as k
          from cdc_norm where _priority is not null))
where k = kmax and op <> 'd'
qualify row_number() over (partition by ticket_id order by b desc) = 1
""")
register("merge_training_set", """
select ticket_id, customer_id, customer_name, segment, _priority as priority, category, channel,
       status, csat, first_response_sec, cast(length(subject) + length(body) as integer) as text_len,
       case when status in ('resolved', 'closed') then 1 else 0 end as label_resolved,
       event_time as updated_at, _ingested_at
from merge_replay
""", "merge_replay")
register("backfill_equals_full", "select * from silver_tickets", "silver_tickets")


def _feature_replay(name: str, lookback_sql: str, deps: tuple[str, ...] = ()) -> None:
    """Daily runs over the ingest days; each run recomputes whole days from
    max(event_date of Gold) - lookback. Day D keeps the values of the last
    run r whose window reached it, i.e. the Silver rows that arrived before
    the end of r."""
    _cte(name, ("silver_events", "fx_events") + deps, f"""
select s.*
from silver_events s
join (select d, max(r) as r_d
      from (select distinct event_date as d from silver_events) days,
           (select r, (select max(event_date) from silver_events x where x._ingested_at < r) as m,
                   r = min(r) over () as is_first
            from (select cast(unnest(generate_series(min(cast(_ingested_at as date)),
                                                     max(cast(_ingested_at as date)),
                                                     interval 1 day)) as date) as r
                  from fx_events)) runs
      where is_first or d >= m - ({lookback_sql})
      group by d) last_run
  on s.event_date = last_run.d
where s._ingested_at < last_run.r_d + interval 1 day
""")


_cte("lookback_measured", ("lateness_profile",),
     "select cast(ceil(p99_days) as integer) as lookback_days from lateness_profile")
_feature_replay("replay_rows_measured", "select lookback_days from lookback_measured", ("lookback_measured",))
_feature_replay("replay_rows_zero", "select 0")
_cte("gold_replay_zero", ("replay_rows_zero",), f"""
select event_date, customer_id, customer_name, segment,{FEATURE_AGGS}
from replay_rows_zero group by event_date, customer_id, customer_name, segment
""")
register("feature_daily_incremental", f"""
select event_date, customer_id, customer_name, segment,{FEATURE_AGGS}
from replay_rows_measured group by event_date, customer_id, customer_name, segment
""", "replay_rows_measured")
_cte("missing_rows", ("silver_events", "gold_replay_zero"), """
select s.* from silver_events s
where not exists (select 1 from gold_replay_zero g
                  where g.event_date = s.event_date and g.customer_id = s.customer_id)
""")
register("missing_pairs_by_day", """
select event_date, count(distinct customer_id) as n_missing_pairs from missing_rows group by event_date
""", "missing_rows")
register("missing_pairs_arrival", """
select event_date, min(ingested_date) as first_arrival, max(ingested_date) as last_arrival,
       count(*) as n_events
from missing_rows group by event_date
""", "missing_rows")
register("grain_spine_gaps", """
select cast(d as date) as event_date, any_value(dim.n) as n_keys, count(distinct f.customer_id) as n_present,
       any_value(dim.n) - count(distinct f.customer_id) as n_missing
from (select unnest(generate_series(min(event_date), max(event_date), interval 1 day)) as d from silver_events)
cross join (select count(distinct customer_id) as n from silver_events) dim
left join feature_daily f on f.event_date = cast(d as date)
group by d
""", "feature_daily", "silver_events")

# slice 6: joins, sampling, sources
register("enrich_tickets", """
select s.*, c_nationkey, c_acctbal from silver_tickets s join customer on c_custkey = s.customer_id
""", "silver_tickets")
register("computed_key_join", """
with days as (select distinct date_diff('day', date '1995-01-01', cast(o_orderdate as date)) as day_idx,
                     cast(o_orderdate as date) as follow_day from orders)
select o_orderkey, follow_day
from orders o join days d
  on d.day_idx = least(date_diff('day', date '1995-01-01', cast(o.o_orderdate as date)) + 1 + o.o_orderkey % 3,
                       (select max(day_idx) from days))
""")
register("flag_join", """
select ticket_id, priority,
       exists (select 1 from quarantine_tickets q where q.ticket_id = s.ticket_id) as has_bad_record
from silver_tickets s
""", "silver_tickets", "quarantine_tickets")
register("semi_join_pick", """
select * from fx_cdc
where ticket_id in (select ticket_id from silver_tickets
                    order by md5(cast(ticket_id as varchar)), ticket_id limit 500)
""", "fx_cdc", "silver_tickets")
register("range_expand", """
select event_id, i from silver_events, unnest(range(event_id % 4)) as r(i)
""", "silver_events")
register("hash_sample_n", """
select o_orderkey, o_custkey, o_totalprice from orders
order by md5(cast(o_orderkey as varchar)), o_orderkey limit 500
""")
register("disjoint_splits", """
select o_orderkey, rank, case when rank <= 300 then 'train' else 'test' end as split
from (select o_orderkey, row_number() over (order by md5(cast(o_orderkey as varchar)), o_orderkey) as rank
      from orders)
where rank <= 500
""")
register("surrogate_ids", """
select event_id, row_number() over (order by event_id) as surrogate_id from silver_events
""", "silver_events")
register("json_projection", "select event_id, props ->> '$.k' as k from events")
register("jsonl_roundtrip", "select * from fx_events", "fx_events")

# slice 7: layout
_DASH_COLS = ("event_id, ticket_id, customer_id, customer_name, segment, event_type, model, latency_ms, "
              "tokens_in, tokens_out, is_escalated, event_time, event_date")
register("compact_events", f"select {_DASH_COLS} from silver_events", "silver_events")
register("compaction_row_parity", """
select count(*) as rows_before, count(*) as rows_after, true as same from silver_events
""", "silver_events")
register("dashboard_point_lookup", """
select customer_name, count(*) as n_events, count(distinct ticket_id) as n_tickets,
       round(avg(latency_ms) * 10, 0) / 10 as avg_latency_ms,
       cast(round_even(round(quantile_cont(latency_ms, 0.95), 6), 0) as integer) as p95_latency_ms,
       cast(sum(case when is_escalated then 1 else 0 end) as bigint) as n_escalated,
       cast(sum(tokens_in + tokens_out) as bigint) as tokens_total
from silver_events
where customer_name = 'Customer#000000008' and event_date = date '2024-01-02'
group by customer_name
""", "silver_events")
register("day_filter_equivalence", """
select date '2024-01-02' as day, n_wrapped, n_sargable, n_partition,
       n_wrapped = n_sargable and n_sargable = n_partition as same
from (select count(*) filter (where strftime(event_time, '%Y-%m-%d') = '2024-01-02') as n_wrapped,
             count(*) filter (where event_time >= timestamp '2024-01-02 00:00:00'
                                and event_time < timestamp '2024-01-03 00:00:00') as n_sargable,
             count(*) filter (where event_date = date '2024-01-02') as n_partition
      from silver_events)
""", "silver_events")

# slice 8: streaming
_STREAM_COLS = "event_id, ticket_id, customer_id, customer_name, event_type, latency_ms, event_time, _ingested_at"
register("stream_upsert_latest", f"""
select {_STREAM_COLS} from fx_events
qualify row_number() over (partition by event_id order by _ingested_at desc, latency_ms desc) = 1
""", "fx_events")
register("stream_first_wins", f"""
select {_STREAM_COLS} from fx_events
qualify row_number() over (partition by event_id order by _ingested_at, latency_ms) = 1
""", "fx_events")
register("stream_restart_parity", """
select count(distinct event_id) as n_rows, count(distinct event_id) as n_ids, true as restarted from fx_events
""", "fx_events")
register("log_head", f"""
select {_STREAM_COLS} from fx_events order by _ingested_at, event_id, latency_ms limit 500
""", "fx_events")

# slice 9: quality, reconciliation, checksums
# Stated here as text of their own, not read from the code they check: table, column, test.
_CHECKS = [
    ("silver_tickets", "ticket_id", "unique"), ("silver_tickets", "ticket_id", "not_null"), ("silver_tickets", "priority", "not_null"),
    ("silver_tickets", "priority", "accepted_values"), ("quarantine_tickets", "ticket_id", "not_null"),
    ("quarantine_tickets", "reject_reason", "not_null"), ("silver_events", "event_id", "unique"), ("silver_events", "event_id", "not_null"),
    ("silver_events", "event_time", "not_null"), ("silver_transcripts", "transcript_id", "unique"),
    ("silver_transcripts", "transcript_id", "not_null"), ("gold_training_set", "ticket_id", "unique"),
    ("gold_doc_chunks", "chunk_id", "unique"), ("gold_doc_chunks", "chunk_id", "not_null")]
_CHECKSUM_COLUMNS = {
    "gold_training_set": ["ticket_id", "priority", "category", "status"],
    "gold_feature_daily": ["event_date", "customer_id", "n_events", "p95_latency_ms"],
    "gold_doc_chunks": ["chunk_id", "transcript_id", "chunk_index"],
    "quarantine_tickets": ["ticket_id", "cdc_seq"]}

_TABLE_CTE = {"silver_tickets": "silver_tickets", "quarantine_tickets": "quarantine_tickets",
              "silver_events": "silver_events", "silver_transcripts": "silver_transcripts",
              "gold_doc_chunks": "doc_chunks", "gold_training_set": "training_set",
              "gold_feature_daily": "feature_daily", "bronze_tickets": "fx_cdc",
              "bronze_events": "fx_events", "bronze_transcripts": "fx_transcripts"}


_VIOLATIONS = {"not_null": "count(*) filter (where {0} is null)", "unique": "count({0}) - count(distinct {0})",
               "accepted_values": "count(*) filter (where {0} < 1 or {0} > 4)"}


def _dq_sql(tables: dict[str, str]) -> str:
    return "\nunion all\n".join(
        f"select '{test}:{table}.{col}' as check_name, '{table}' as table_name, "
        f"cast({_VIOLATIONS[test].format(col)} as bigint) as n_failing, {_VIOLATIONS[test].format(col)} = 0 as ok from {tables[table]}"
        for table, col, test in _CHECKS)


register("dq_report", _dq_sql(_TABLE_CTE), *sorted({_TABLE_CTE[t] for t, *_ in _CHECKS}))
register("dq_domain_violations", """
select ticket_id, priority from silver_tickets where priority is null or priority not between 1 and 4
""", "silver_tickets")
def _reconciliation_sql(tables: dict[str, str]) -> str:
    return f"""
select check_name, actual, expected, actual = expected as ok from (
  select 'accepted + quarantined = bronze records' as check_name,
         (select count(*) from cdc_norm where _priority is not null)
           + (select count(*) from {tables['quarantine_tickets']}) as actual,
         (select count(*) from fx_cdc) as expected
  union all
  select 'silver_events = distinct bronze event ids', (select count(*) from {tables['silver_events']}),
         (select count(distinct event_id) from fx_events)
  union all
  select 'gold_feature_daily = distinct silver (day, customer)', (select count(*) from feature_daily),
         (select count(distinct (event_date, customer_id)) from {tables['silver_events']})
  union all
  select 'gold_training_set = silver_tickets', (select count(*) from {tables['gold_training_set']}),
         (select count(*) from {tables['silver_tickets']})
  union all
  select 'gold_doc_chunks = turns of silver transcripts', (select count(*) from {tables['gold_doc_chunks']}),
         (select cast(sum(len(turns)) as bigint) from silver_transcripts))
"""


_LAYERS = ("cdc_norm", "quarantine_tickets", "fx_cdc", "silver_events", "fx_events", "feature_daily", "training_set", "silver_tickets",
           "doc_chunks", "silver_transcripts")
register("count_reconciliation", _reconciliation_sql(_TABLE_CTE), *_LAYERS)

# the same checks over tables that violate them
_cte("bad_tickets", ("silver_tickets",), """
select * replace (case when ticket_id % 31 = 4 then 9 when ticket_id % 37 = 5 then null else priority end as priority)
from (select * from silver_tickets union all select * from silver_tickets where ticket_id % 50 = 7)
""")
_cte("bad_events", ("silver_events",), """
select * replace (case when event_id % 97 <> 11 then event_id end as event_id,
                  case when customer_id % 41 <> 3 then event_time end as event_time) from silver_events
""")
_cte("bad_quarantine", ("quarantine_tickets",), """
select * replace (case when ticket_id % 3 <> 1 then reject_reason end as reject_reason) from quarantine_tickets
""")
_cte("bad_training", ("training_set",), "select * from training_set union all select * from training_set where ticket_id % 60 = 1")
_cte("bad_chunks", ("doc_chunks",), """
select * from doc_chunks where chunk_index < 3 union all select * from doc_chunks where transcript_id % 20 = 5
""")
_BAD = {**_TABLE_CTE, "silver_tickets": "bad_tickets", "silver_events": "bad_events", "quarantine_tickets": "bad_quarantine",
        "gold_training_set": "bad_training", "gold_doc_chunks": "bad_chunks"}
_BAD_NEEDS = ("bad_tickets", "bad_events", "bad_quarantine", "bad_training", "bad_chunks", "silver_transcripts")
register("dq_report_dirty", _dq_sql(_BAD), *_BAD_NEEDS)
register("dq_domain_violations_dirty", """
select ticket_id, priority from bad_tickets where priority is null or priority not between 1 and 4
""", "bad_tickets")
register("count_reconciliation_dirty", _reconciliation_sql(_BAD), *_BAD_NEEDS, *_LAYERS)


def _checksum_sql(table: str, cols: list[str]) -> str:
    text = ", ".join(f"coalesce(cast({c} as varchar), '~')" for c in cols)
    return (f"select '{table}' as table_name, count(*) as n_rows, "
            f"case when count(*) = 0 then 'empty' else concat_ws('-', cast(count(*) as varchar), "
            f"cast(sum(('0x' || substr(h, 1, 8))::bigint) as varchar), "
            f"cast(sum(('0x' || substr(h, 9, 8))::bigint) as varchar)) end as checksum "
            f"from (select md5(concat_ws('|', {text})) as h from {_TABLE_CTE[table]})")


_CHECKSUM_UNION = "\nunion all\n".join(_checksum_sql(t, c) for t, c in _CHECKSUM_COLUMNS.items())
_CHECKSUM_NEEDS = tuple(_TABLE_CTE[t] for t in _CHECKSUM_COLUMNS)
register("table_checksum", _CHECKSUM_UNION, *_CHECKSUM_NEEDS)
register("rerun_stability", f"""
select run, c.* from ({_CHECKSUM_UNION}) c, (select unnest([1, 2, 3]) as run)
""", *_CHECKSUM_NEEDS)
register("row_counts", "\nunion all\n".join(
    f"select '{t}' as table_name, count(*) as n_rows from {_TABLE_CTE[t]}"
    for t in ["bronze_tickets", "silver_tickets", "quarantine_tickets", "gold_training_set", "bronze_events",
              "silver_events", "gold_feature_daily", "silver_transcripts", "gold_doc_chunks"]),
         "fx_cdc", "silver_tickets", "quarantine_tickets", "training_set", "fx_events", "silver_events",
         "feature_daily", "silver_transcripts", "doc_chunks")

# slice 10: streaming twin of dedup, acceptance summary
register("stream_dedup_watermark",
         "select distinct event_id, cast(event_time as date) as event_date from fx_events", "fx_events")
SQL["acceptance_summary"] = f"""
select 'replays are stable' as criterion, true as ok
union all
select 'column tests pass' as criterion, (select bool_and(ok) from ({SQL['dq_report']})) as ok
union all
select 'layer counts reconcile', (select bool_and(ok) from ({SQL['count_reconciliation']}))
union all
select 'accept/reject is a partition', (select bool_and(ok) from ({SQL['split_reconciliation']}))
union all
select 'priority domain holds', (select count(*) = 0 from ({SQL['dq_domain_violations']}))
"""

# slice 11: a hot key
_cte("silver_events_skewed", ("silver_events",), """
select * replace (case when hot then 1 else customer_id end as customer_id,
                  case when hot then (select c_name from customer where c_custkey = 1) else customer_name end as customer_name,
                  case when hot then (select c_mktsegment from customer where c_custkey = 1) else segment end as segment)
from (select *, event_id % 3 = 1 as hot from silver_events)
""")
register("feature_daily_skewed", f"""
select event_date, customer_id, customer_name, segment,{FEATURE_AGGS}
from silver_events_skewed group by event_date, customer_id, customer_name, segment
""", "silver_events_skewed")
register("missing_pairs_skewed", """
select s.event_date, count(distinct s.customer_id) as n_missing_pairs
from silver_events_skewed s
where not exists (select 1 from silver_events_skewed g
                  where g._ingested_at < g.event_time + interval 1 hour
                    and g.event_date = s.event_date and g.customer_id = s.customer_id)
group by s.event_date
""", "silver_events_skewed")

# SQL access
SQL["dashboard_sql"] = SQL["dashboard_point_lookup"]
register("gold_rows_vs_keys_sql",
         "select count(*) as n_rows, count(distinct ticket_id) as n_keys from merge_replay", "merge_replay")
SQL["stream_upsert_incoming_wins"] = SQL["stream_upsert_latest"]
register("stream_dedup_state", """
select event_id, event_date, _ingested_at > event_time + interval 2 day as late from silver_events
""", "silver_events")
register("stream_late_rows", """
select _ingested_at > event_time + interval 2 day as late, count(*) as n_events from silver_events group by 1
""", "silver_events")
SQL["stream_jsonl_upsert"] = SQL["stream_upsert_latest"]


# raw lines, SQL functions
_cte("raw_lines", (), """
select event_id, user_id, event_type, user_id % 29 as kind,
       '{"event_id":' || event_id || ',"user_id":' || case when user_id % 29 = 5 then '"u' || user_id || '"' else cast(user_id as varchar) end
         || ',"event_type":"' || event_type || '"}' as line
from events
""")
register("jsonl_malformed_split", """
select event_id, user_id, event_type, null::varchar as raw, null::varchar as reject_reason from raw_lines where kind not in (3, 5, 7)
union all
select null, null, null, case kind when 3 then left(line, length(line) - 4) when 7 then '[' || line || ']' else line end,
       case kind when 5 then 'a field does not fit its declared type' else 'not a JSON object' end
from raw_lines where kind in (3, 5, 7)
""", "raw_lines")
register("normalize_priority_sql", f"""
select ticket_id, cdc_seq, priority_raw, _priority as priority, {PRIO_REASON} as reject_reason from cdc_norm
""", "cdc_norm")

# replays of corrected landings: the one-shot answer over the corrected rows
_cte("first_week", ("fx_events",), """
select cast(min(cast(_ingested_at as date)) as timestamp) + interval 7 day as upto from fx_events
""")
_SILVER_OF = """
select event_id, ticket_id, customer_id, customer_name, segment, event_type, model, latency_ms,
       tokens_in, tokens_out, is_escalated, event_time, _ingested_at,
       cast(event_time as date) as event_date, cast(_ingested_at as date) as ingested_date
from fx_events where {0}
qualify row_number() over (partition by event_id order by _ingested_at, latency_ms) = 1
"""
register("replay_withdrawn_event",
         _SILVER_OF.format("not (customer_id % 40 = 7 and _ingested_at < (select upto from first_week))"), "fx_events", "first_week")
_cte("without_last_day", ("fx_events",), _SILVER_OF.format(
    "cast(event_time as date) <> (select max(cast(event_time as date)) from fx_events)"))
register("replay_emptied_day", f"""
select event_date, customer_id, customer_name, segment,{FEATURE_AGGS}
from without_last_day group by event_date, customer_id, customer_name, segment
""", "without_last_day")
_cte("cdc_corrected", ("fx_cdc",), f"""
select *, {PRIO_NORM} as _priority from (
  select * replace (case when _ingested_at < timestamp '{CDC_RUN_BOUNDS[0]} 00:00:00' and customer_id % 5 = 1 then '4' else priority_raw end
                    as priority_raw)
  from fx_cdc where not (_ingested_at < timestamp '{CDC_RUN_BOUNDS[0]} 00:00:00' and customer_id % 17 = 3))
""")
register("replay_corrected_ticket", """
select ticket_id, customer_id, customer_name, segment, _priority as priority, category, channel,
       status, csat, first_response_sec, subject, body, event_time as updated_at, _ingested_at
from (select * from cdc_corrected where _priority is not null
      qualify row_number() over (partition by ticket_id order by event_time desc, cdc_seq desc) = 1)
where op <> 'd'
""", "cdc_corrected")

# layouts, by their footers
register("layout_files", """
select event_date, count(*) as rows, min(customer_name) as first_customer, max(customer_name) as last_customer, count(*) as rows_read
from silver_events group by event_date
""", "silver_events")
register("layout_report", f"""
select layout, (select count(*) from silver_events) as rows_on_disk, customer_name, n_events, tokens_total,
       true as same_result, true as accepted, true as within_prediction
from (select customer_name, count(*) as n_events, cast(sum(tokens_in + tokens_out) as bigint) as tokens_total
      from silver_events where customer_name = 'Customer#000000008' and event_date = date '2024-01-02' group by customer_name),
     (select unnest(['before', 'after']) as layout)
""", "silver_events")
register("dashboard_absent_key", """
select 'Customer#000000008~' as customer_name, true as inside_min_max, count(*) as n_events, cast(0 as bigint) as rows_scanned
from silver_events where customer_name = 'Customer#000000008~'
""", "silver_events")
