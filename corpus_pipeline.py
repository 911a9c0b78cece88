"""Cleaning a corpus in five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillgrid.llm.decontaminate import drop_contaminated  # noqa: E402
from quillgrid.llm.exact_dedup import drop_exact_copies  # noqa: E402
from quillgrid.llm.minhash import drop_near_copies  # noqa: E402
from quillgrid.llm.queries import piece_model  # noqa: E402
from quillgrid.llm.sentencepiece_codec import encode  # noqa: E402
from quillgrid.llm.toxicity import drop_toxic  # noqa: E402
from quillgrid.session import written_table  # noqa: E402


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labels that are not held out."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of the rows whose texts are equal but for white space stays."""
    return drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    return drop_near_copies(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, word for word or with other values, go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers) and the text decoded from them."""
    return encode(docs, piece_model()).select(
        F.col("id").alias("doc_id"), (F.length("tokens") / 4).cast("long").alias("n_tokens"), F.col("tokens").alias("ids"), "decoded"
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("minhash_near_dedup", near_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("sentencepiece", encode_stage),
]

# The toxicity model and the token ids cannot be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir.rstrip("/")), f"stage-{name}")
    return docs
