"""Documents to training tokens, stage by stage.

Each stage takes all that the one before it kept and returns the columns of
documents; the last adds the ids. Between stages the documents are written to
the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulmart.llm import leaks, pieces, quality, simhash, surrogates
from haulmart.llm.shared import keep


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return leaks.without_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    return surrogates.with_surrogates(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``token_ids`` and ``n_tokens``."""
    return pieces.encoded(docs)


STAGES = [
    ("quality rules", good),
    ("near-duplicates", distinct),
    ("benchmark decontamination", uncontaminated),
    ("personal data", private),
    ("SentencePiece ids", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else keep(docs, f"stage-{k}"), sf_dir)
    return docs


# Fingerprints, alignments, keyed surrogates and piece ids are beyond SQL; the
# tests hold the stages against brute force instead.
ORACLE_SQL = None
