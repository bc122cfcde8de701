"""Benchmark decontamination: size-partitioned MinHash containment search
(DataFrame functions only).

Test items are partitioned by the size of their shingle set, [2^k, 2^(k+1)).
The partition's upper size u sets the sketch: the floor((1-t)*u)+1 shingles of
the item with the smallest minhash values (all, if it has fewer). A document
that contains at least the share t of an item misses fewer shingles than the
sketch holds, so it holds one of the sketch: the search has no false
negatives at any document length. (Bands over whole documents would need
thousands of minhashes: an item of 30 words in a document of 20,000 has a
Jaccard similarity of 0.0015.) Candidates are verified by exact containment on
the full sets.

Scale: documents' shingles meet the sketches in one pass. Whether the sketches or the
items' sets are broadcast is decided by the counted bytes (``broadcast_bytes``);
beyond that the same join shuffles. Candidates are pre-aggregated to
(document, item) on the map side, so a passage that a third of all documents
hold costs one row per document. Verification joins (document, shingle) hashes of the
candidates with the items' and counts; no text or array is copied per item.

Defined cases: words are runs of letters and digits, lower-cased, so
punctuation next to a passage doesn't hide it. An item of fewer than five
words is one shingle, its whole sequence, and is found only in a document of
exactly these words; an item without words is never found. Null or empty
texts contain nothing. Rows with equal id and text are all reported. Items with
equal text are each reported; rows with one item id are one item, whose shingles are those of all its texts; a null item id is
an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from stratum.llm.text import shingles
from stratum.operators.ordering import written


def match_words(col: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(col, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _small(df: DataFrame, bytes_a_row: int, limit: int) -> DataFrame:
    """Broadcast, if the counted rows prove that it is small."""
    return F.broadcast(df) if df.count() * bytes_a_row <= limit else df


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", shingle: int = 5,
               num: int = 75, den: int = 100, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` rows with their columns, plus ``_item``, ``_item_shingles`` and
    ``_matched``: one row for each item of which the document contains at least
    ``num``/``den`` of the distinct shingles."""
    # words are a column of their own: inlined, they would be split anew for every shingle
    held_by_item = (items.select(F.col(item_id).alias("_item"), match_words(F.col(item_text)).alias("_w"))
                         .select("_item", F.explode(shingles(F.col("_w"), shingle)).alias("_s")).distinct())
    held_by_item = written(held_by_item.withColumn("_k", F.xxhash64(F.lit(5), F.col("_item"))), "items")
    sizes = held_by_item.groupBy("_k", "_item").agg(F.count(F.lit(1)).alias("_n"))
    # size partition: the upper bound of [2^k, 2^(k+1)) fixes the sketch length
    upper = F.pow(F.lit(2), F.floor(F.log2("_n")) + 1).cast("long") - 1
    length = F.floor(upper * (den - num) / den) + 1
    best = Window.partitionBy("_k").orderBy("_h", "_s")
    postings = written(held_by_item.select("_k", "_s", F.xxhash64("_s", F.lit(1)).alias("_h"))
                       .withColumn("_rank", F.row_number().over(best))
                       .join(sizes.select("_k", length.alias("_length")), "_k").where("_rank <= _length").select("_k", "_s"), "sketches")

    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("t"),
                   F.xxhash64(F.lit(7), F.col(text_col)).alias("u"))
    held = (docs.select(key.alias("_doc"), match_words(F.col(text_col)).alias("_w"))
                .select("_doc", F.explode(shingles(F.col("_w"), shingle)).alias("_s")))
    candidates = written(held.join(_small(postings, 24, broadcast_bytes), "_s").select("_doc", "_k").distinct(), "candidates")
    # whole sets of the candidates only: their documents' shingles, each once, against the items'
    wide = docs.withColumn("_doc", key)
    ids = candidates.select(F.col("_doc").alias("_cdoc")).distinct()
    again = (wide.join(ids, F.col("_doc").eqNullSafe(F.col("_cdoc")), "left_semi").dropDuplicates(["_doc"])
                 .select("_doc", match_words(F.col(text_col)).alias("_w"))
                 .select("_doc", F.explode(shingles(F.col("_w"), shingle)).alias("_s")))
    matched = again.join(_small(held_by_item.select("_k", "_s"), 24, broadcast_bytes), "_s").groupBy("_doc", "_k").agg(
        F.count(F.lit(1)).alias("_matched"))
    pairs = (matched.join(sizes, "_k").where(den * F.col("_matched") >= num * F.col("_n"))
                    .select(F.col("_doc").alias("_pdoc"), "_item", F.col("_n").cast("long").alias("_item_shingles"),
                            F.col("_matched").cast("long").alias("_matched")))
    return wide.join(pairs, F.col("_doc").eqNullSafe(F.col("_pdoc"))).drop("_doc", "_pdoc")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """``docs`` without the rows that contain a test item."""
    key = [F.xxhash64(F.col(text_col)).alias("_t"), F.xxhash64(F.lit(7), F.col(text_col)).alias("_u")]
    bad = (find_leaks(docs, items, id_col, text_col, **options)
           .select(F.col(id_col).alias("_id"), *key).distinct())
    mine = docs.withColumns({"_t1": F.xxhash64(F.col(text_col)), "_u1": F.xxhash64(F.lit(7), F.col(text_col))})
    return mine.join(bad, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_t1") == F.col("_t"))
                     & (F.col("_u1") == F.col("_u")), "left_anti").drop("_t1", "_u1")
