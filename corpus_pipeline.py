"""Corpus pipeline: documents through filters and deduplication to piece ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from targetlens.llm.decontamination import keep_clean
from targetlens.llm.line_dedup import dedup_lines, similar_characters
from targetlens.llm.piece_codec import encode_pieces
from targetlens.llm.quality_rules import keep_good
from targetlens.llm.simhash_dedup import keep_one
from targetlens.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the limits of their language and source go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; every document stays, with ``n_chars`` of what is left of its text."""
    kept = dedup_lines(docs, similar=similar_characters, segments=True)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether decoding them gives its text back."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode_pieces(docs, path, check_col="round_trip").select(
        "doc_id", "lang", "source", "n_chars", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"), "round_trip"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", decontamination),
    ("sentencepiece encoding and decoding", sentencepiece_codec),
]
#: SQL can express neither the quantile sketches nor the connected groups nor the best path.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage reads what the one before it has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
