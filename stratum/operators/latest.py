"""Row-per-key selection: first arrival, latest state, CDC reconstruction.

``row_number() = 1`` over a key lets Catalyst plant a partial
``WindowGroupLimit`` before the shuffle, so each map task already keeps one
row per key; the shuffle moves at most one row per key and task. Keys here
are entity ids (events, tickets, transcripts), so no single key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratum.functions.normalize import normalize_domain

_RN = "_rn"


def top1_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep, per key, the first row under ``order`` (which must be total)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def first_arrival(df: DataFrame, key: str, arrival: str = "_ingested_at",
                  tie_break: Sequence[str] = ()) -> DataFrame:
    """First delivery per key; equal arrival times are told apart by
    ``tie_break``, then by all other columns, so every build keeps the same row."""
    rest = [c for c in df.columns if c not in (key, arrival, *tie_break)]
    return top1_per_key(df, [key], [F.col(c).asc() for c in (arrival, *tie_break, *rest)])


def latest_state(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Newest record per key by ``order`` descending."""
    return top1_per_key(df, [key], [F.col(c).desc() for c in order])


# --- Silver models ---------------------------------------------------------------

EVENT_COLUMNS = [
    "event_id", "ticket_id", "customer_id", "customer_name", "segment", "event_type",
    "model", "latency_ms", "tokens_in", "tokens_out", "is_escalated", "event_time", "_ingested_at",
]


def event_shape(bronze_events: DataFrame) -> DataFrame:
    """Silver event columns (no dedup): payload plus event and arrival day."""
    return bronze_events.select(
        *EVENT_COLUMNS,
        F.to_date("event_time").alias("event_date"),
        F.to_date("_ingested_at").alias("ingested_date"),
    )


def silver_events(bronze_events: DataFrame) -> DataFrame:
    """One row per ``event_id``: the first delivery wins; adds the event and
    arrival days."""
    return first_arrival(event_shape(bronze_events), "event_id", tie_break=["latency_ms"])


TRANSCRIPT_COLUMNS = ["transcript_id", "ticket_id", "lang", "turns", "event_time", "_ingested_at"]


def transcript_shape(bronze_transcripts: DataFrame) -> DataFrame:
    return bronze_transcripts.select(*TRANSCRIPT_COLUMNS)


def silver_transcripts(bronze_transcripts: DataFrame) -> DataFrame:
    return first_arrival(transcript_shape(bronze_transcripts), "transcript_id")


TICKET_COLUMNS = [
    "ticket_id", "customer_id", "customer_name", "segment", "priority", "category",
    "channel", "status", "csat", "first_response_sec", "subject", "body",
    "updated_at", "_ingested_at",
]
CDC_ORDER = ["event_time", "cdc_seq"]


def _silver_projection(df: DataFrame) -> DataFrame:
    renamed = {"priority": F.col("_priority").alias("priority"), "updated_at": F.col("event_time").alias("updated_at")}
    return df.select(*[renamed.get(c, F.col(c)) for c in TICKET_COLUMNS])


def silver_tickets(bronze_cdc: DataFrame, raw: str = "priority_raw",
                   exempt_tombstones: bool = False) -> DataFrame:
    """Latest valid state per ticket.

    Order matters: invalid *records* are dropped first, then each ticket is
    ranked, then tombstones (``op = 'd'``) are removed. A ticket whose newest
    record is bad keeps its previous valid state. By default a tombstone with
    a bad payload is rejected like any record (so the ticket stays live);
    ``exempt_tombstones`` lets deletes through the contract.
    """
    ok = F.col("_priority").isNotNull()
    if exempt_tombstones:
        ok = ok | (F.col("op") == "d")
    valid = bronze_cdc.withColumn("_priority", normalize_domain(raw)).where(ok)
    latest = latest_state(valid, "ticket_id", CDC_ORDER)
    return _silver_projection(latest.where(F.col("op") != "d"))


def silver_from_state(state: DataFrame) -> DataFrame:
    """Live tickets from a latest-valid-record-per-ticket state table (the
    incremental form of ``silver_tickets``)."""
    return _silver_projection(state.where(F.col("op") != "d"))


def silver_tickets_rank_first(bronze_cdc: DataFrame, raw: str = "priority_raw") -> DataFrame:
    """The wrong order (rank, then filter), kept as a contrast: tickets whose
    newest record is bad disappear."""
    latest = latest_state(bronze_cdc, "ticket_id", CDC_ORDER).withColumn("_priority", normalize_domain(raw))
    return _silver_projection(latest.where(F.col("_priority").isNotNull() & (F.col("op") != "d")))


def rank_then_filter_loss(bronze_cdc: DataFrame) -> DataFrame:
    """One row: live tickets under both orders and how many the wrong one loses."""
    tagged = (silver_tickets(bronze_cdc).select(F.lit(True).alias("_right"))
              .unionByName(silver_tickets_rank_first(bronze_cdc).select(F.lit(False).alias("_right"))))
    return tagged.agg(
        F.count_if(F.col("_right")).alias("n_filter_then_rank"),
        F.count_if(~F.col("_right")).alias("n_rank_then_filter"),
    ).withColumn("n_lost", F.col("n_filter_then_rank") - F.col("n_rank_then_filter"))
