"""A training corpus from documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legalops.llm import bpe, exact_dedup, minhash, mixing, toxicity
from legalops.llm.common import small_batches, staged

VOCABULARY = "byte_bpe_50k.json"
# Texts sent to a worker at once; a task holds them on both sides.
BATCH_ROWS = 500


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model learns from labels of these documents."""
    scored = toxicity.score(docs.select(F.struct("*").alias("row"), "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 0").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity of 0.8)."""
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, as digests, and what they decode to. Written here, since batches are small only while it runs."""
    with small_batches(spark, BATCH_ROWS):
        made = bpe.encode_digests(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY)).drop("text")
        return staged(made, "digests")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# The classifier, the signatures and the tokenizer are beyond SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
