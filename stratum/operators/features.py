"""Daily feature aggregates (routing features, dashboard tile).

The rows move once, to the task of their (day, customer); everything else happens there. The
exact p95 is read off the sorted latencies, by rank: a ``percentile`` buffer per group costs far more than the
few rows of an ordinary group, and a sort spills where a buffer must fit. Distinct tickets are read off a sort too:
``count_distinct`` would hash every row by all group columns and the ticket first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stratum.functions.numeric import round_scaled, to_int_half_even
from stratum.operators.quantiles import grouped_quantile

FEATURE_KEY = ["event_date", "customer_id"]
FEATURE_GROUP = ["event_date", "customer_id", "customer_name", "segment"]


def feature_daily(silver_events: DataFrame) -> DataFrame:
    """Grain: one row per (event_date, customer_id)."""
    group = Window.partitionBy(*FEATURE_GROUP)
    ordered = group.orderBy(F.col("latency_ms").asc_nulls_last())
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # the same sort as for the rank
    ticket, before = F.col("ticket_id"), F.lag("ticket_id").over(group.orderBy("ticket_id"))
    value, at, rank = F.col("latency_ms").cast("double"), F.col("_at"), F.col("_rank")
    ranked = (silver_events.select(*FEATURE_GROUP, "ticket_id", "is_escalated", "latency_ms", "tokens_in", "tokens_out")
              .repartition(*FEATURE_KEY)
              .withColumn("_new", ticket.isNotNull() & (before.isNull() | (before != ticket)))
              .withColumns({"_at": (F.count("latency_ms").over(whole) - 1) * 0.95, "_rank": F.row_number().over(ordered) - 1}))
    lower, upper = F.col("_lower"), F.col("_upper")
    # interpolated as ``percentile`` does it
    p95 = F.when(lower == upper, lower).otherwise((F.ceil(at) - at) * lower + (at - F.floor(at)) * upper)
    return ranked.groupBy(*FEATURE_GROUP).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if("_new").alias("n_tickets"),
        F.count_if(F.col("is_escalated")).alias("n_escalated"),
        round_scaled(F.avg("latency_ms"), 2).alias("avg_latency_ms"),
        F.max("_at").alias("_at"),
        F.max(F.when(rank == F.floor(at), value)).alias("_lower"),
        F.max(F.when(rank == F.ceil(at), value)).alias("_upper"),
        F.sum("tokens_in").alias("tokens_in"),
        F.sum("tokens_out").alias("tokens_out"),
    ).select(*FEATURE_GROUP, "n_events", "n_tickets", "n_escalated", "avg_latency_ms",
             to_int_half_even(p95).alias("p95_latency_ms"), "tokens_in", "tokens_out")


def feature_daily_any_size(silver_events: DataFrame) -> DataFrame:
    """``feature_daily`` for groups of any size: the p95 is found by counting (``quantiles``), so no task holds
    a hot customer's distinct latencies. The plain form is one pass less and right for ordinary groups."""
    plain = silver_events.groupBy(*FEATURE_GROUP).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct("ticket_id").alias("n_tickets"),
        F.count_if(F.col("is_escalated")).alias("n_escalated"),
        round_scaled(F.avg("latency_ms"), 2).alias("avg_latency_ms"),
        F.sum("tokens_in").alias("tokens_in"),
        F.sum("tokens_out").alias("tokens_out"),
    )
    p95 = grouped_quantile(silver_events, FEATURE_GROUP, "latency_ms", 0.95, "_p95")
    p95 = p95.select(*[F.col(c).alias(f"_{c}") for c in FEATURE_GROUP], "_p95")
    same = F.lit(True)
    for c in FEATURE_GROUP:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return plain.join(p95, same).select(*FEATURE_GROUP, "n_events", "n_tickets", "n_escalated", "avg_latency_ms",
                                        to_int_half_even(F.col("_p95")).alias("p95_latency_ms"), "tokens_in", "tokens_out")


def dashboard_tile(events: DataFrame) -> DataFrame:
    """Per-customer tile over whatever rows the caller's filter left."""
    return events.groupBy("customer_name").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct("ticket_id").alias("n_tickets"),
        round_scaled(F.avg("latency_ms"), 1).alias("avg_latency_ms"),
        to_int_half_even(F.percentile("latency_ms", 0.95)).alias("p95_latency_ms"),
        F.count_if(F.col("is_escalated")).alias("n_escalated"),
        F.sum(F.col("tokens_in").cast("long") + F.col("tokens_out").cast("long")).alias("tokens_total"),
    )
