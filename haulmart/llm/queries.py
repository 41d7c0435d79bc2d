"""The operators applied to whole supplied tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmart.llm import (
    attribution, chat, hilbert, idstore, leaks, negatives, packing, phrases, pieces, quality, simhash,
    surrogates, toxicity,
)
from haulmart.llm.oracle import ORACLE_SQL
from haulmart.llm.shared import keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return attribution.section_tokens(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.sharded(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trips(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op7_token_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idstore.stored_digests(_table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, as logs, rendered and read back."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    chats = chat.parsed(keep(chat.formatted(chat.log_of(rows.unionByName(more))), "chats"))
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = F.array_join(
        F.transform(
            "loss_spans",
            lambda s: chat.unescape(F.col("formatted").substr(s["start"].cast("int") + 1, s["length"])),
        ),
        "",
    )
    return chats.withColumn("loss", loss).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = surrogates.replaced(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("row.doc_id").alias("doc_id"), "text", "n_entities")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies, with a digest of its ids."""
    return packing.packed(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", packing.crc32_of("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth id is an anchor; the labels of every seventh are changed first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), moved.alias("label"),
        negatives.whole_vector(F.col("embedding")).alias("vector"),
    )
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_toxicity, op3_hilbert_sharding, op4_simhash_near_dedup,
        op5_sentencepiece, op6_quality_rules, op7_token_id_store, op8_chat_formatting,
        op9_pii_surrogates, op10_benchmark_decontamination, op11_packing, op12_hard_negatives,
        op13_phrases,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES"]
