"""Data-quality checks, reconciliations and order-free table checksums.

Every check is an aggregation that Spark runs distributed; reports are
small DataFrames (one row per check), never driver-side loops over data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# --- gaps between Silver and Gold -----------------------------------------------------

PAIR = ["event_date", "customer_id"]


def missing_pairs(silver: DataFrame, gold: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Silver rows whose (day, customer) pair has no Gold row (anti join)."""
    return silver.join(gold.select(*keys), list(keys), "left_anti")


def missing_pairs_by_day(silver: DataFrame, gold: DataFrame) -> DataFrame:
    return (missing_pairs(silver, gold).groupBy("event_date")
            .agg(F.count_distinct("customer_id").alias("n_missing_pairs")))


def missing_pairs_arrival(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Earliest and latest arrival day and row count behind missing pairs."""
    return (missing_pairs(silver, gold).groupBy("event_date")
            .agg(F.min("ingested_date").alias("first_arrival"),
                 F.max("ingested_date").alias("last_arrival"),
                 F.count(F.lit(1)).alias("n_events")))


def grain_gaps(gold: DataFrame, dim: DataFrame, day: str, key: str) -> DataFrame:
    """Complete-grain check without materialising the day x key spine.

    Per calendar day from the first to the last: keys in the dimension, keys
    present, and the gap; a day without any row misses every key. The spine's
    width is a scalar count and its days are a sequence, so no cross join is needed.
    """
    n_dim = dim.agg(F.count_distinct(key)).scalar()
    per_day = gold.groupBy(day).agg(F.count_distinct(key).alias("_n"))
    span = per_day.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).where("lo is not null")
    calendar = span.select(F.explode(F.sequence("lo", "hi")).alias(day))
    return (calendar.join(per_day, day, "left")
            .select(day, n_dim.alias("n_keys"), F.coalesce("_n", F.lit(0)).alias("n_present"))
            .withColumn("n_missing", F.col("n_keys") - F.col("n_present")))


# --- column tests ----------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    table: str
    test: str      # unique | not_null | accepted_values
    column: str
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.test}:{self.table}.{self.column}"


def _violations(check: Check) -> Column:
    c = F.col(check.column)
    if check.test == "not_null":
        return F.count_if(c.isNull())
    if check.test == "unique":  # rows beyond the first per non-null value
        return F.count(c) - F.count_distinct(c)
    if check.test == "accepted_values":  # NULL is not_null's job
        return F.count_if(c.isNotNull() & ~c.isin(*check.values))
    raise ValueError(check.test)


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One aggregation pass per table; result rows: check, table, failures, ok."""
    parts = []
    for tname, df in tables.items():
        mine = [c for c in checks if c.table == tname]
        if not mine:
            continue
        agg = df.agg(*[_violations(c).alias(f"c{i}") for i, c in enumerate(mine)])
        rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"),
                                  F.col(f"c{i}").cast("long").alias("n_failing"))
                         for i, c in enumerate(mine)])
        parts.append(agg.select(F.inline(rows)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ok", F.col("n_failing") == 0)


# --- fixed values: the column tests of the Silver and Gold contracts ---
DEFAULT_CHECKS = [
    Check("silver_tickets", "unique", "ticket_id"),
    Check("silver_tickets", "not_null", "ticket_id"),
    Check("silver_tickets", "not_null", "priority"),
    Check("silver_tickets", "accepted_values", "priority", (1, 2, 3, 4)),
    Check("quarantine_tickets", "not_null", "ticket_id"),
    Check("quarantine_tickets", "not_null", "reject_reason"),
    Check("silver_events", "unique", "event_id"),
    Check("silver_events", "not_null", "event_id"),
    Check("silver_events", "not_null", "event_time"),
    Check("silver_transcripts", "unique", "transcript_id"),
    Check("silver_transcripts", "not_null", "transcript_id"),
    Check("gold_training_set", "unique", "ticket_id"),
    Check("gold_doc_chunks", "unique", "chunk_id"),
    Check("gold_doc_chunks", "not_null", "chunk_id"),
]


def domain_violations(df: DataFrame, col: str = "priority", lo: int = 1, hi: int = 4,
                      key: str = "ticket_id") -> DataFrame:
    c = F.col(col)
    return df.where(c.isNull() | ~c.between(lo, hi)).select(key, col)


# --- fixed values: the declared type contract of Silver tickets ---
SILVER_TICKETS_CONTRACT = {
    "ticket_id": "bigint", "customer_id": "bigint", "customer_name": "string", "segment": "string", "priority": "int",
    "category": "string", "channel": "string", "status": "string", "csat": "int", "first_response_sec": "int",
    "subject": "string", "body": "string", "updated_at": "timestamp_ntz", "_ingested_at": "timestamp_ntz",
}


def check_contract(df: DataFrame, contract: StructType | dict[str, str]) -> None:
    """Enforced type contract: names and types must match exactly."""
    from stratum.plans.writers import check_schema
    check_schema(df, contract)


# --- reconciliation ----------------------------------------------------------------------

def table_counts(tables: Sequence[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """(name, n) of every aggregate, with one pass per table."""
    out = None
    for df, aggs in tables:
        one = df.agg(*[c.cast("long").alias(k) for k, c in aggs.items()])
        part = one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).alias("n")) for k in aggs])))
        out = part if out is None else out.unionByName(part)
    return out


def reconcile_counts(counts: DataFrame, checks: Sequence[tuple[str, Sequence[str], str]]) -> DataFrame:
    """Rows of (check_name, actual, expected, ok): the sum of the named counts against another one. ``counts`` has a row
    per aggregate, so few that one task holds them."""
    held = counts.agg(F.map_from_entries(F.collect_list(F.struct("name", F.coalesce("n", F.lit(0))))).alias("m"))

    def total(names):
        return sum((F.element_at("m", F.lit(x)) for x in names[1:]), F.element_at("m", F.lit(names[0])))

    rows = [F.struct(F.lit(name).alias("check_name"), total(actual).alias("actual"), F.element_at("m", F.lit(expected)).alias("expected"))
            for name, actual, expected in checks]
    return held.select(F.inline(F.array(*rows))).withColumn("ok", F.col("actual") == F.col("expected"))


def layer_counts(cdc: DataFrame, events: DataFrame, transcripts: DataFrame) -> DataFrame:
    """(table_name, n_rows) of every layer, with one aggregation per Bronze
    source: rows are first counted per entity, so Silver and Gold follow from
    conditional sums over entities."""
    from stratum.operators import latest, quarantine

    def rows(agg: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("table_name"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("n_rows"))
                 for c in agg.columns]
        return agg.select(F.inline(F.array(*pairs)))

    tagged = quarantine.tag(cdc.select("ticket_id", "op", *latest.CDC_ORDER, "priority_raw"))
    valid = F.col("_priority").isNotNull()
    newest = F.max_by(F.when(valid, F.col("op")), F.when(valid, F.struct(*latest.CDC_ORDER)))
    tickets = tagged.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(~valid).alias("bad"),
                                              newest.alias("op"))
    live = F.count_if(F.col("op") != "d")
    a = tickets.agg(F.sum("n").alias("bronze_tickets"), live.alias("silver_tickets"),
                    F.sum("bad").alias("quarantine_tickets"), live.alias("gold_training_set"))
    first = F.min_by(F.struct("event_time", "customer_id", "customer_name", "segment"),
                     F.struct("_ingested_at", "latency_ms", "event_time", "customer_id"))
    per_event = events.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), first.alias("f"))
    per_day = (per_event.groupBy(F.to_date("f.event_time").alias("d"), "f.customer_id", "f.customer_name", "f.segment")
                        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("ids")))
    b = per_day.agg(F.sum("n").alias("bronze_events"), F.sum("ids").alias("silver_events"),
                    F.count(F.lit(1)).alias("gold_feature_daily"))
    per_id = transcripts.groupBy("transcript_id").agg(
        F.min_by(F.greatest(F.size("turns"), F.lit(0)), "_ingested_at").alias("turns"))
    c = per_id.agg(F.count(F.lit(1)).alias("silver_transcripts"), F.sum("turns").alias("gold_doc_chunks"))
    return rows(a).unionByName(rows(b)).unionByName(rows(c))


# --- checksums -----------------------------------------------------------------------------

def row_text(cols: Sequence[str]) -> Column:
    """``c1|c2|...`` with NULL as ``~`` (column order as given)."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols])


def _half(h: Column, start: int) -> Column:
    return F.conv(F.substring(h, start, 8), 16, 10).cast("decimal(38,0)")


def checksum(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Order-free checksum of the chosen columns: row count plus the sums of
    the two leading 32-bit words of each row's md5.

    A plain aggregate (partial sums per task), so it scales to any table
    size; equal multisets of rows give equal checksums. Empty -> ``empty``.
    """
    h = F.md5(row_text(cols))
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(_half(h, 1)).alias("s1"),
                 F.sum(_half(h, 9)).alias("s2"))
    return agg.select(
        "n_rows",
        F.when(F.col("n_rows") == 0, F.lit("empty"))
         .otherwise(F.concat_ws("-", F.col("n_rows").cast("string"), F.col("s1").cast("string"),
                                F.col("s2").cast("string"))).alias("checksum"))


# --- fixed values: checksum columns per Gold table ---
GOLD_CHECKSUM_COLUMNS = {
    "gold_training_set": ["ticket_id", "priority", "category", "status"],
    "gold_feature_daily": ["event_date", "customer_id", "n_events", "p95_latency_ms"],
    "gold_doc_chunks": ["chunk_id", "transcript_id", "chunk_index"],
    "quarantine_tickets": ["ticket_id", "cdc_seq"],
}


def table_checksums(tables: dict[str, DataFrame], columns: dict[str, list[str]] | None = None) -> DataFrame:
    columns = columns or GOLD_CHECKSUM_COLUMNS
    out = None
    for name, df in tables.items():
        part = checksum(df, columns.get(name, df.columns)).select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out
