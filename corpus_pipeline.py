"""From raw documents to token ids: language ID, exact and near duplicates, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and returns documents with all their columns, without those it rejects; the last
returns doc_id, token_ids, n_tokens and round_trip. ``docs`` is a scan of a written table. Empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from trialmetrics.llm import decontaminate, exact_dedup, language_id, pieces, simhash
from trialmetrics.llm.common import fresh, numbered, stored


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; texts that are null or without a letter are rejected."""
    trees = language_id.fitted(docs, "text", "lang", F.lit(True))
    return language_id.in_a_language(docs, trees)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space the longest, then the one with the smallest id."""
    row = fresh(docs, "row")
    rows = numbered(docs, row)
    return _kept(rows, row, exact_dedup.exact_duplicates(rows, carry=[row]))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of three-word shingles, at most two bits apart, the one with the smallest id."""
    row = fresh(docs, "row")
    rows = numbered(docs, row)
    return _kept(rows, row, simhash.near_duplicates(rows, carry=[row], shingle=3, bits=2))


def _kept(rows: DataFrame, row: str, judged: DataFrame) -> DataFrame:
    kept = judged.filter("kept").select(F.col("carry_0").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), remove="documents", width=10)


def as_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids, n_tokens, and whether decoding the ids gives the text again."""
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", in_a_language),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("sentencepiece", as_token_ids),
]

#: No SQL: two stages depend on a trained model and on XXH64, one on a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
