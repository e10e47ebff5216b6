"""The corpus pipeline: five stages over ``documents``, each written and read again before the next.

A stage takes ``(spark, docs, sf_dir)`` and applies one operator to all documents its predecessor kept. All but
the last return the columns of ``documents``. Tables that an operator needs beside the documents come from
``sf_dir``. Columns may hold nulls, rows may repeat, and the documents may be none; what an operator makes of
that is in its own docstring.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendworks.llm import bpe, line_dedup, mixing, quality, simhash
from lendworks.llm.queries import BPE_RANKS, bpe_digests
from lendworks.staging import Stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good; it learns from ``labels``."""
    scored = quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.filter("predicted = 1").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier run repeats; one that loses all its text that way goes.

    ``n_chars`` follows the text. Documents that lose nothing are kept as they are, empty ones included.
    """
    left = line_dedup.line_dedup(docs, count="_lines_removed").filter(
        (F.col("_lines_removed") == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != "")
    )
    if "n_chars" in docs.columns:
        length = F.when(F.col("_lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.near_dedup(docs, shingle=3, distance=3).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target rate says, in a hashed order."""
    return mixing.mix(docs, copy=None).select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the ids and of what they decode to."""
    encoded = bpe.encode(docs.select("doc_id", "text"), BPE_RANKS, public_tokenizers.PATTERN, decoded=True)
    return bpe_digests(encoded)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE", bpe_stage),
]

#: SQL cannot express the trained and tokenising stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stage = spark.read.parquet(f"{sf_dir}/documents.parquet"), Stage(spark)
    for at, (_, apply) in enumerate(STAGES):
        docs = stage.table(f"stage_{at}", lambda: apply(spark, docs, sf_dir))
    return docs
