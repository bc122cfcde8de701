"""SQL access: the warehouse tables as temporary views.

Users who query tables by name keep doing so with ``spark.sql``; Catalyst
plans the statement the same way as the DataFrame models (pruning, pushed
filters, partition filters on day folders).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.functions.normalize import (INT_PATTERN, PRIORITY_LABELS, PRIORITY_MAX, PRIORITY_MIN, REASON_EMPTY, REASON_NULL,
                                         REASON_OUT_OF_RANGE, REASON_UNKNOWN)
from stratum.plans.jobs import Warehouse


def warehouse_tables(wh: Warehouse) -> dict[str, DataFrame | None]:
    return {
        "bronze_tickets_cdc": wh.bronze("tickets") if "tickets" in wh.landing else None,
        "bronze_events": wh.bronze("events") if "events" in wh.landing else None,
        "bronze_transcripts": wh.bronze("transcripts") if "transcripts" in wh.landing else None,
        "silver_tickets": wh.silver_tickets(),
        "silver_events": wh.silver_events(),
        "silver_transcripts": wh.silver_transcripts(),
        "quarantine_tickets": wh.quarantine(),
        "gold_training_set": wh.training_set(),
        "gold_feature_daily": wh.feature_daily(),
        "gold_doc_chunks": wh.doc_chunks(),
    }


def register_views(wh: Warehouse) -> list[str]:
    """Create or replace one temporary view per existing table; returns the names."""
    names = []
    for name, df in warehouse_tables(wh).items():
        if df is not None:
            df.createOrReplaceTempView(name)
            names.append(name)
    return names


def priority_sql(raw: str = "raw") -> str:
    """``normalize_domain`` of the priority contract as a Spark SQL expression."""
    number = f"case when {raw} rlike '{INT_PATTERN}' then try_cast({raw} as int) end"
    labels = " ".join(f"when lower(trim({raw})) = '{k}' then {v}" for k, v in PRIORITY_LABELS.items())
    return f"case when {number} between {PRIORITY_MIN} and {PRIORITY_MAX} then {number} {labels} end"


def reason_sql(raw: str = "raw") -> str:
    """``reject_reason`` of the priority contract as a Spark SQL expression."""
    return (f"case when {priority_sql(raw)} is not null then null when {raw} is null then '{REASON_NULL}' "
            f"when trim({raw}) = '' then '{REASON_EMPTY}' when {raw} rlike '{INT_PATTERN}' and try_cast({raw} as int) is not null "
            f"then '{REASON_OUT_OF_RANGE}' else '{REASON_UNKNOWN}' end")


def register_functions(spark: SparkSession) -> list[str]:
    """``normalize_priority(raw)`` and ``priority_reject_reason(raw)`` as temporary SQL functions. Catalyst inlines
    their bodies, so a statement that calls them plans like one with the expressions written out."""
    bodies = {"normalize_priority": ("int", priority_sql()), "priority_reject_reason": ("string", reason_sql())}
    for name, (kind, body) in bodies.items():
        spark.sql(f"create or replace temporary function {name}(raw string) returns {kind} return {body}")
    return sorted(bodies)


def register_dataset(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A Parquet folder (plain or Hive-partitioned) as a view."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df
