"""Token counts and BPE against the tokenizers library."""

from __future__ import annotations

import random
import tracemalloc
from hashlib import sha256

import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from legalops.llm import bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _texts():
    rng = random.Random(4)
    made = [None, "", " ", "\n\n", "a", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "aaaa" * 500, " " * 3000]
    made += ["Ᲊᲊ a꟎b", "日本語 text\x1c\x85é​", "it's we'll 12345 'S"]
    for alphabet in ("ab", "aA b", "é ü日本​ ", "abc<|endoftext|> '", "aaaa\n\t ", "🎉👨‍👩‍👧 x"):
        made += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(90))) for _ in range(15)]
    made.append("".join(rng.choice("abcdefghijklmnop") for _ in range(8000)))
    return made + made[:3]


def _frame(spark, texts):
    rows = [(i, t, 5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")


def test_counts_equal_the_library(spark, library):
    texts = _texts()
    found = {r["doc_id"]: r for r in token_counts.count_tokens(_frame(spark, texts), PATH, limit=100).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (found[i]["n_bytes"], found[i]["n_tokens"], found[i]["over_limit"]) == (
            len((text or "").encode()), n, n > 100
        )


def test_ids_equal_the_library_and_decode_back(spark, library):
    texts = _texts()
    df = _frame(spark, texts)
    full = {r["doc_id"]: r for r in bpe.encode(df, PATH).collect()}
    digests = {r["doc_id"]: r for r in bpe.encode_digests(df, PATH).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (full[i]["ids"], full[i]["decoded"]) == (ids, back) and back == (text or "")
        row = digests[i]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == sha256(back.encode()).hexdigest()


def test_empty_table(spark):
    none = _frame(spark, [])
    assert token_counts.count_tokens(none, PATH).collect() == []
    assert bpe.encode_digests(none, PATH).collect() == []


def test_a_remembered_chunk_takes_little_memory():
    encoder = bpe.Encoder(bpe.load(PATH))
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(20_000)]
    encoder.digests(" ".join(words))
    held = list(encoder.known)
    encoder.known.clear()
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    encoder.digests(" ".join(words))
    took = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert len(encoder.known) == len(held) > 19_000
    assert took / len(held) < 230


def test_the_pipeline_sends_texts_to_the_encoder_in_small_batches(spark, monkeypatch):
    @F.pandas_udf("long")
    def rows(texts: pd.Series) -> pd.Series:
        return pd.Series([len(texts)] * len(texts))

    monkeypatch.setattr(bpe, "encode_digests", lambda df, path: df.withColumn("rows", rows("text")))
    docs = spark.range(3000).coalesce(1).selectExpr("id doc_id", "'some words' text")
    found = [r["rows"] for r in corpus_pipeline.encode(spark, docs, "").collect()]
    assert len(found) == 3000 and max(found) <= corpus_pipeline.BATCH_ROWS
