"""The queries of this subpackage over the whole tables of a scale folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legalops.llm import (
    bpe,
    chat,
    embedding_dedup,
    exact_dedup,
    fill_middle,
    hard_negatives,
    minhash,
    mixing,
    pii,
    quality,
    token_counts,
    toxicity,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _on_documents(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: op(_table(spark, sf_dir, "documents"))


def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    return chat.read_back(chat.segments(turns.union(own)))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, _table(spark, sf_dir, "labels")).drop("text")


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality.score(docs, _table(spark, sf_dir, "labels"), host_col="source", path_col="lang")


# Rules of the URL filter, as (host and path, verdict).
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


def _hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Query]:
    path = public_tokenizers.path(VOCABULARY)
    ids = ["doc_id", "text"]
    return {
        "op1_pii": _on_documents(pii.personal_data_digests),
        "op2_exact_dedup": _on_documents(exact_dedup.exact_duplicates),
        "op3_toxicity": _toxicity,
        "op4_token_counts": _on_documents(lambda d: token_counts.count_tokens(d.select(*ids), path).drop("text")),
        "op5_quality": _quality,
        "op6_mixing": _on_documents(mixing.mix_words),
        "op7_chat": _chat,
        "op8_embedding_dedup": lambda spark, sf_dir: embedding_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings")),
        "op9_minhash": _on_documents(lambda d: minhash.near_duplicates(d, words=4)),
        "op10_bpe": _on_documents(lambda d: bpe.encode_digests(d.select(*ids), path).drop("text")),
        "op11_fill_middle": _on_documents(fill_middle.fill_in_middle_digests),
        "op12_url_filter": lambda spark, sf_dir: url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES).drop("url", "html"),
        "op13_hard_negatives": _hard_negatives,
    }
