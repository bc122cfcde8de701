"""Quality rules with cross-document line frequency.

Base rules per document (one Python pass over Arrow batches; per row a small
helper): word and symbol counts, repeated lines, words in repeated 8-word
windows. The method's rule: lines are normalised and hashed, distinct documents
are counted per host and line, a line in more than ``max_docs`` documents of a host,
the same number for every host, is removed everywhere except in its keeper, and a
document left with too small a share of its words is rejected.

The keeper is the largest id among the holders that pass the base rules and are not
depleted even without any over-frequent line; if there is none, the largest id
that passes the base rules, which is then not rejected as depleted. So every
line that a passing document holds stays in a kept one; a line without a passing holder is
removed from all.

Scale: exploded lines travel as (document key, position, host, hash, words), the
count is a two-level aggregate with map-side combining, and the lookup joins two plain
exchanges that AQE splits for a hot host or line. The figures and the lines over the
limit are written once, so the text is read for them one time each.

Defined cases: null text: no words, one empty line, base_failed. Null host: a
host of its own. Null id: an id of its own, smaller than all others. Rows with
equal id, text and host are one document and all are returned.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratum.llm.text import SPACE_RE, ascii_lower, hash128, lines, strip_space, without_positions, words
from stratum.session import scratch_dir, small_batches

WINDOW = 8
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_SPACE = re.compile(SPACE_RE)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_window_words(tokens: list, window: int = WINDOW) -> int:
    """Words that lie in a ``window``-word window found at least twice."""
    n = len(tokens) - window + 1
    if n < 2:
        return 0
    ids: dict = {}
    seq = np.fromiter((ids.setdefault(t, len(ids)) for t in tokens), np.uint64, len(tokens))
    if len(ids) == len(tokens):
        return 0
    seq = (seq + np.uint64(1)) * _MIX
    seq ^= seq >> np.uint64(29)
    h = np.zeros(n, np.uint64)
    for k in range(window):
        h = (h ^ seq[k:k + n]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(len(tokens) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def base_figures(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    if not text:
        return 0, 0, 0, 0, 0
    tokens = [t for t in _SPACE.split(text) if t]
    seen: set = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(" \t\n\v\f\r"):
            seen.add(line)
    return (len(tokens), sum(map(len, tokens)), len(_SYMBOLS.findall(text)), dup, repeated_window_words(tokens))


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in FIGURES]))
def _base(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([base_figures(t) for t in texts],
                        columns=FIGURES)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  min_words: int = 20, max_repeat_pct: int = 30, max_docs: int = 20, min_left_pct: int = 30) -> DataFrame:
    """``docs`` with its columns, plus ``_q`` (base figures), ``_removed_words``,
    ``_base_failed``, ``_kept`` and ``_kept_text`` (the text without removed lines)."""
    spark, paths = docs.sparkSession, [scratch_dir(docs.sparkSession, f"quality-{x}") for x in ("figures", "lines")]
    own = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("t"),
                   F.xxhash64(F.lit(7), F.col(text_col)).alias("u"))
    host = F.coalesce(F.xxhash64(F.lit(1), F.col(host_col)), F.lit(0))
    each = (docs.select(own.alias("_doc"), host.alias("_host"), F.posexplode(lines(F.col(text_col))).alias("_pos", "_line"))
                .withColumn("_key", ascii_lower(strip_space(F.col("_line")))).where("_key <> ''")
                .select("_doc", "_host", "_pos", hash128(F.col("_key")).alias("_h"),
                        F.size(words(F.col("_key"))).alias("_words")))
    common = (each.groupBy("_host", "_h", F.col("_doc.id").alias("_id")).agg(F.lit(1).alias("_one"))
                  .groupBy("_host", "_h").agg(F.count(F.lit(1)).alias("_docs")).where(F.col("_docs") > max_docs)
                  .select(F.xxhash64("_host", "_h.a", "_h.b").alias("_j"), F.col("_host").alias("_chost"), F.col("_h").alias("_ch")))
    held = each.withColumn("_j", F.xxhash64("_host", "_h.a", "_h.b")).join(
        common.withColumnRenamed("_j", "_cj"),
        (F.col("_j") == F.col("_cj")) & (F.col("_h") == F.col("_ch")) & (F.col("_host") == F.col("_chost")))
    docs = docs.withColumn("_doc", own).withColumn("_host", host)
    with small_batches(spark):
        (docs.select("_doc", "_host", _base(F.col(text_col)).alias("_q"))
             .groupBy("_doc", "_host").agg(F.first("_q").alias("_q")).write.parquet(paths[0]))
    (held.groupBy("_doc", "_host", "_pos").agg(F.first("_words").alias("_words"), F.first("_h").alias("_h"))
         .write.parquet(paths[1]))
    figures, at = (spark.read.parquet(p) for p in paths)

    def beside(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        r = right.withColumnRenamed("_doc", "_rdoc").withColumnRenamed("_host", "_rhost")
        return left.join(r, F.col("_doc").eqNullSafe(F.col("_rdoc")) & (F.col("_host") == F.col("_rhost")), how).drop("_rdoc", "_rhost")

    # not depleted without any of its over-frequent lines: whoever keeps them, this document stays
    safe = beside(at.groupBy("_doc", "_host").agg(F.sum("_words").alias("_all")), figures, "inner")
    safe = (safe.where(~_fails("_q", min_words, max_repeat_pct))
                .select("_doc", "_host", (~_depleted("_q", F.col("_all"), min_left_pct)).alias("_safe")))
    keepers = (beside(at, safe, "inner").groupBy("_host", "_h")
               .agg(F.max(F.struct(F.col("_safe"), F.col("_doc.id").alias("id"))).alias("_keeper"))
               .select(F.xxhash64("_host", "_h.a", "_h.b").alias("_kj"), F.col("_host").alias("_khost"),
                       F.col("_h").alias("_kh"), "_keeper"))
    stays = F.col("_keeper").isNotNull() & F.col("_doc.id").eqNullSafe(F.col("_keeper.id"))
    placed = (at.withColumn("_j", F.xxhash64("_host", "_h.a", "_h.b"))
                .join(keepers, (F.col("_j") == F.col("_kj")) & (F.col("_h") == F.col("_kh"))
                      & (F.col("_host") == F.col("_khost")), "left").withColumn("_stays", stays))
    removed = placed.groupBy("_doc", "_host").agg(
        F.sum(F.when(~F.col("_stays"), F.col("_words"))).alias("_removed_words"), F.bool_or("_stays").alias("_keeps"),
        F.sort_array(F.collect_list(F.when(~F.col("_stays"), F.col("_pos")))).alias("_drop"))
    out = beside(docs, beside(figures, removed, "left"), "inner").drop("_doc", "_host")
    out = out.withColumn("_removed_words", F.coalesce("_removed_words", F.lit(0)).cast("long"))
    failed = _fails("_q", min_words, max_repeat_pct)
    depleted = _depleted("_q", F.col("_removed_words"), min_left_pct) & ~F.coalesce("_keeps", F.lit(False))
    return (out.withColumn("_base_failed", failed).withColumn("_kept", ~failed & ~depleted)
               .withColumn("_kept_text", _without(text_col)).drop("_drop", "_keeps"))


def _fails(figures: str, min_words: int, max_repeat_pct: int) -> Column:
    n = F.col(f"{figures}.n_words")
    return (n < min_words) | (100 * F.col(f"{figures}.n_repeat_words") > max_repeat_pct * n)


def _depleted(figures: str, removed_words: Column, min_left_pct: int) -> Column:
    n = F.col(f"{figures}.n_words")
    return 100 * (n - removed_words) < min_left_pct * n


def _without(text_col: str) -> Column:
    kept = without_positions(lines(F.col(text_col)), F.col("_drop"))
    return F.when(F.col("_drop").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))

