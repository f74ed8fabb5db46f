"""The corpus pipeline: quality rules, near-dedup, substring dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; ``run`` writes each stage's result as Parquet to the shared
checkpoint folder and reads it again, so that a lost executor costs a re-read
only. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from creditlake.llm import bpe, mixing, near_dedup, quality, seed_extend
from creditlake.llm.common import ready, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the certified thresholds reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates stays."""
    return near_dedup.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in 50-word passages of documents with a smaller id go; every document stays."""
    return seed_extend.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, their number, and a digest of the text decoded from them."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    emitted = "n_tokens long, ids array<int>, decoded_sha256 string"
    return bpe.encode(docs, vocabulary, keep=("doc_id", "lang", "source"), emit=bpe.emit_ids_and_digest, emitted=emitted)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("mixing", source_mix),
    ("bpe", tokens),
]

#: Tokenizers have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{ready(spark).sparkContext.getCheckpointDir().rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
