"""A training-data pipeline over ``documents``; each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.llm import minmax, mixing, packing, risk_rules, secrets
from pennant.llm.common import word_count, written
from pennant.llm.queries import tokenizer_path
from pennant.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rule or a risk-controlled cutoff go."""
    return risk_rules.apply_rules(docs, read_table(spark, sf_dir, "labels")).where("kept").select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Min-max near-dedup at similarity 0.8 or more: the smallest doc_id of each group stays."""
    return minmax.keep_one(docs, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that the forest confirms are replaced by a mark; no document goes."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: documents are repeated or left out by their source's rate."""
    return mixing.emit(mixing.mix(docs, word_count(F.col("text"))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing into sequences of 2048 tokens along the Hilbert curve."""
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), 2048, 1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("secrets", secret_scan), ("mix", mix), ("pack", pack)]

#: The secret scan's forest and the tokeniser are beyond SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; what a stage returns is written and read again as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
