"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratum.llm import (chat_format, collocations, conversation_repair, decontaminate, langid, line_dedup, mixing,
                         near_dedup, packing, quality, secrets, sharding, warc)
from stratum.llm.oracle import SQL
from stratum.session import scratch_dir

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(_table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_archives(manifest, with_payload=False).select(
        F.col("record_key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", F.col("_item").alias("item_id"), F.col("_item_shingles").alias("item_shingles"),
                        F.col("_matched").alias("matched"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = chat_format.rotate_perspectives(_table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return views.select(F.col("conv").alias("conv_id"), "participant", "n_turns", "n_own", "rendered", spans.alias("mask"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    sample = langid.learning_sample(docs.where(~langid.held_out("doc_id")))
    guessed = langid.predict_language(docs.select("doc_id", "text"), sample)
    return guessed.select("doc_id", langid.held_out("doc_id").alias("held_out"), F.col("_lang_pred").alias("lang_pred"),
                          F.col("_score").alias("score"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = scratch_dir(spark, "blob-ledger")
    secrets.scan_increment(docs, ledger)
    return secrets.findings(docs, ledger).select(
        "doc_id", F.col("_n_assign").alias("n_assign"), F.col("_n_access").alias("n_access"),
        F.col("_n_hex").alias("n_hex"), F.sha2("_spans", 256).alias("base_sha256"), F.col("_spans").alias("spans"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                       F.sha2("_kept_text", 256).alias("kept_sha256"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  public_tokenizers.path(TOKENIZER)).drop("row", "fill")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dedup.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return classes.select("doc_id", F.col("_n_shingles").alias("n_shingles"), F.col("_component").alias("component_id"),
                          F.col("_kept").alias("kept"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rated.select("doc_id", "_q.*", F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
                        F.col("_removed_words").alias("removed_words"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return sharded.select("doc_id", F.col("_size").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                          F.lit("bytes").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
                          F.lit(None).cast("int").alias("grown_shard"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(_table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_conversations(damaged, "conv", lost_col="lost").withColumnRenamed("conv", "conv_id")


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(_table(spark, sf_dir, "documents"))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_warc, op2_decontamination, op3_chat_formatting, op4_language_id, op5_secret_scan, op6_line_dedup,
        op7_best_fit_packing, op8_near_dedup, op9_quality_rules, op10_sharding,
        op11_conversation_repair, op12_source_mixing, op13_collocations, pipeline)}

__all__ = ["QUERIES", "SQL"]
