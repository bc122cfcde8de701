"""Gold classifier training set: one row per live ticket."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# --- fixed values: statuses that count as a resolved label ---
RESOLVED_STATUSES = ["resolved", "closed"]

TRAINING_COLUMNS = [
    "ticket_id", "customer_id", "customer_name", "segment", "priority", "category", "channel",
    "status", "csat", "first_response_sec", "text_len", "label_resolved", "updated_at", "_ingested_at",
]


def training_set(silver_tickets: DataFrame) -> DataFrame:
    return silver_tickets.select(
        "ticket_id", "customer_id", "customer_name", "segment", "priority", "category", "channel",
        "status", "csat", "first_response_sec",
        (F.length("subject") + F.length("body")).alias("text_len"),
        F.when(F.col("status").isin(*RESOLVED_STATUSES), 1).otherwise(0).alias("label_resolved"),
        "updated_at", "_ingested_at",
    )
