"""Line deduplication across documents (DataFrame functions only).

Lines are exploded with their position, normalised and hashed to 128 bits;
distinct documents are counted per hash; a line found in enough documents
stays only in the document with the largest id; each text is put together
again from the slices between the dropped positions, so work per document is
linear in its lines.

Scale: only lines long enough to be dropped are exploded, and they travel as
(document key, position, hash), never as text. The count is a two-level
aggregate (per line and document, then per line), so a line that a third of
all documents hold is pre-aggregated on the map side. The lookup of shared
lines joins two plain exchanges, which AQE splits for a hot line. The text is
exchanged once, by document.

Defined cases: null or empty text is one empty line. Rows with equal id and
text are one document, each of them is returned. Rows with one id and
different texts count as one document per line but are put together
separately. A null id is a document id of its own, smaller than all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratum.llm.text import ascii_lower, hash128, lines, strip_space, without_positions


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with its columns, plus ``_n_lines``, ``_n_dropped`` and ``_kept_text``.

    A line's key is the line with ASCII white space stripped at both ends and
    A-Z lower-cased. Keys of at least ``min_chars`` code points in at least
    ``min_docs`` documents lose all lines outside the largest id holding it.
    """
    own = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("t"),
                   F.xxhash64(F.lit(7), F.col(text_col)).alias("u"))
    keyed = docs.select(own.alias("_doc"), lines(F.col(text_col)).alias("_lines"))
    exploded = (keyed.select("_doc", F.posexplode("_lines").alias("_pos", "_line"))
                     .withColumn("_key", ascii_lower(strip_space(F.col("_line"))))
                     .where(F.char_length("_key") >= min_chars)
                     .select("_doc", "_pos", hash128(F.col("_key")).alias("_h")))
    shared = (exploded.groupBy("_h", F.col("_doc.id").alias("_id")).agg(F.lit(1).alias("_one"))
                      .groupBy("_h").agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_keeper"))
                      .where(F.col("_docs") >= min_docs)
                      # a hash of the key as the join key: both sides get a plain exchange, which AQE can split
                      .select(F.xxhash64("_h.a", "_h.b").alias("_j"), F.col("_h").alias("_sh"), "_keeper"))
    hit = exploded.withColumn("_j", F.xxhash64("_h.a", "_h.b"))
    dropped = (hit.join(shared, (hit["_j"] == shared["_j"]) & (hit["_h"] == shared["_sh"]))
                  .where(~F.col("_doc.id").eqNullSafe(F.col("_keeper")))
                  .groupBy("_doc").agg(F.sort_array(F.collect_set("_pos")).alias("_drop"))
                  .withColumnRenamed("_doc", "_ddoc"))
    whole = docs.withColumn("_doc", own)
    joined = whole.join(dropped, F.col("_doc").eqNullSafe(F.col("_ddoc")), "left").drop("_ddoc")
    cut = (joined.withColumn("_lines", lines(F.col(text_col)))
                 .withColumn("_n_lines", F.size("_lines").cast("long"))
                 .withColumn("_n_dropped", F.coalesce(F.size("_drop"), F.lit(0)).cast("long")))
    drop = F.col("_drop")
    kept = without_positions(F.col("_lines"), drop)
    text = F.when(drop.isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.array_join(kept, "\n"))
    return cut.withColumn("_kept_text", text).drop("_doc", "_drop", "_lines")
