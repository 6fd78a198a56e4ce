"""One query per operator over the given tables, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.llm import (
    automaton_dedup,
    external_shuffle,
    flow_mix,
    hard_negatives,
    importance_resampling,
    line_templates,
    ngram_join,
    scaled_sketch,
    simhash,
    suffix_decontaminate,
    suffix_dedup,
    toxicity,
    warc,
)
from ticksmith.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

SHARDS = 40
WEIGHTS = [3.0, 1.0, 2.0]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_flow_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    mixed, plan = flow_mix.mix(docs, F.array("source"), WEIGHTS)
    plan = plan.select(
        F.col("source").alias("planned"), F.col("size").alias("source_size"), "target"
    )
    # The plan has a row per source, as bounded as the patterns it was made from.
    return mixed.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("planned"))).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    return warc.archive_and_read(spark, pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_suffix_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    benchmark = _table(spark, sf_dir, "benchmark", "item_id", "text")
    found = suffix_decontaminate.matched(docs, benchmark)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        suffix_decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    done = suffix_dedup.remove_repeated_bytes(docs)
    return done.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        _removed().alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _removed():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def op5_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return scaled_sketch.compared(docs).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        scaled_sketch.as_string(F.col("sketch")).alias("fingerprint"),
        scaled_sketch.as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "toxic")
    found = toxicity.scored(docs, labels)
    return found.select("doc_id", "held_out", "score", "predicted", "evidence")


def op7_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    done = automaton_dedup.remove_repeated_words(docs)
    return done.select(
        "doc_id", "n_words", _removed().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return shard_digest(external_shuffle.shuffle_into_shards(docs, SHARDS))


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    done = line_templates.drop_recurring_lines(docs)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def shard_digest(sharded: DataFrame) -> DataFrame:
    body = F.coalesce("text", F.lit(""))
    return sharded.select(
        "doc_id",
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select(
        "doc_id", simhash.hex_fingerprint(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    mislabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # A row without an id has no remainder, and takes no part.
    return hard_negatives.hard_negatives(rows.withColumn("label", mislabelled), F.col("vec_id") % 50 == 0)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    target = _table(spark, sf_dir, "benchmark", "item_id", "text")
    found = importance_resampling.resampled(docs, target, keep=["doc_id"])
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_flow_mix": op1_flow_mix,
    "op2_warc": op2_warc,
    "op3_suffix_decontaminate": op3_suffix_decontaminate,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_scaled_sketch": op5_scaled_sketch,
    "op6_toxicity": op6_toxicity,
    "op7_automaton_dedup": op7_automaton_dedup,
    "op8_external_shuffle": op8_external_shuffle,
    "op9_simhash": op9_simhash,
    "op10_line_templates": op10_line_templates,
    "op11_ngram_join": op11_ngram_join,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_importance_resampling": op13_importance_resampling,
}
