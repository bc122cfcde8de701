"""Contract enforcement with quarantine routing.

One rule (``normalize_domain``) decides both sides: Silver takes the records
it accepts, quarantine takes the records it rejects. Bad rows never raise;
the run goes on and quarantine is the work queue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratum.functions.normalize import normalize_domain, reject_reason

QUARANTINE_COLUMNS = ["ticket_id", "cdc_seq", "op", "event_time", "_ingested_at", "priority_raw",
                      "reject_reason", "customer_id", "customer_name", "category", "status"]
RECORD_KEY = ["ticket_id", "cdc_seq"]


def tag(bronze_cdc: DataFrame, raw: str = "priority_raw") -> DataFrame:
    """Add ``_priority`` (NULL = rejected) once, for both sinks."""
    return bronze_cdc.withColumn("_priority", normalize_domain(raw))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("_priority").isNotNull())


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("_priority").isNull())


def quarantine_tickets(bronze_cdc: DataFrame, raw: str = "priority_raw",
                       exempt_tombstones: bool = False) -> DataFrame:
    """One row per rejected CDC *record* (not per ticket), with the reason.
    With ``exempt_tombstones`` deletes are never quarantined."""
    rej = rejected(tag(bronze_cdc, raw))
    if exempt_tombstones:
        rej = rej.where(F.col("op") != "d")
    rej = rej.withColumn("reject_reason", reject_reason(raw))
    return rej.select(*QUARANTINE_COLUMNS)


def normalized_records(bronze_cdc: DataFrame, raw: str = "priority_raw") -> DataFrame:
    return bronze_cdc.select(*RECORD_KEY, raw, normalize_domain(raw).alias("priority"))


def reject_reason_counts(bronze_cdc: DataFrame) -> DataFrame:
    return quarantine_tickets(bronze_cdc).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def split_reconciliation(bronze_cdc: DataFrame, raw: str = "priority_raw") -> DataFrame:
    """The split is a partition of the input: accepted + rejected = all, and
    no record is on both sides. One row of counts and a verdict."""
    t = tag(bronze_cdc.select(*RECORD_KEY, raw), raw)
    acc, rej = accepted(t).select(*RECORD_KEY), rejected(t).select(*RECORD_KEY)
    overlap = acc.join(rej, RECORD_KEY, "left_semi")
    kinds = (t.select(F.lit("all").alias("k"))
             .unionByName(acc.select(F.lit("acc").alias("k")))
             .unionByName(rej.select(F.lit("rej").alias("k")))
             .unionByName(overlap.select(F.lit("both").alias("k"))))
    counts = kinds.agg(*[F.count_if(F.col("k") == k).alias(n) for k, n in
                         [("all", "n_all"), ("acc", "n_accepted"), ("rej", "n_rejected"), ("both", "n_both")]])
    return counts.withColumn(
        "ok", (F.col("n_accepted") + F.col("n_rejected") == F.col("n_all")) & (F.col("n_both") == 0))
