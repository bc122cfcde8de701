"""Transcript arrays and RAG chunks.

``posexplode`` is a generator inside the scan stage: no shuffle. Empty and
NULL arrays give no rows; NULL elements are kept as NULL chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def assemble_turns(turns: DataFrame, entity: str, order: str, text: str) -> DataFrame:
    """One array per entity, elements ordered by ``order``.

    The output row holds the whole entity by definition, so the group is
    bounded by one conversation; the shuffle is by entity id.
    """
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return turns.groupBy(entity).agg(F.transform(pairs, lambda x: x["t"]).alias("turns"))


def doc_chunks(silver_transcripts: DataFrame) -> DataFrame:
    """One row per turn: ``chunk_id = transcript_id#index``."""
    exploded = silver_transcripts.select(
        "transcript_id", "ticket_id", "lang", "event_time",
        F.posexplode("turns").alias("chunk_index", "chunk_text"))
    return exploded.select(
        F.concat(F.col("transcript_id").cast("string"), F.lit("#"),
                 F.col("chunk_index").cast("string")).alias("chunk_id"),
        "transcript_id", "ticket_id", "lang", "chunk_index", "chunk_text",
        F.length("chunk_text").alias("n_chars"),
        "event_time",
    )
