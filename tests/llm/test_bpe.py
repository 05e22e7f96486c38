import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    with open(PATH, "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    usual = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Codec(ranks, public_tokenizers.PATTERN), usual


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


ODD = ["", " ", "a" * 5000, "é" * 300, "x" * 64, "x" * 65, "ab" * 17, "the" * 2000, "<|endoftext|>", "a b　c \n\n d\r\n", "日本語 텍스트 🙂👍🏽", "\x00\x1c\x1d"]


@pytest.mark.parametrize("text", ODD)
def test_as_the_library(both, text):
    codec, usual = both
    ids = usual.encode_ordinary(text)
    assert codec.encode(text) == packed(ids)
    assert codec.decode(packed(ids)) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=5))
def test_any_text(both, texts):
    codec, usual = both
    assert codec.encode_all(texts) == [packed(usual.encode_ordinary(t)) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=64), min_size=1, max_size=20))
def test_merging_together_is_merging_one_by_one(both, pieces):
    codec, _ = both
    pieces = [p for p in pieces if p not in codec.ranks]
    assert codec.merger.merge(pieces, 6) == [packed(bpe.merge_pieces(p, codec.ranks)) for p in pieces]


def test_columns(spark, both):
    _, usual = both
    texts = [*ODD, None, None, "long text, " * 40_000]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string, decoded string")
    tokenizer = bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    coded = docs.withColumn("coded", tokenizer.round_trip(F.col("text"))).withColumn("alone", tokenizer.encode(F.col("text")))
    coded = coded.withColumn("again", tokenizer.decode(F.col("alone")))
    rows = coded.select("doc_id", "ids", "coded", "alone", "again", bpe.n_tokens(F.col("alone")).alias("n")).collect()
    for row in rows:
        text = texts[row.doc_id] or ""
        ids = usual.encode_ordinary(text)
        assert bytes(row.coded.ids) == bytes(row.alone) == packed(ids) and row.n == len(ids) and row.ids == "x"
        assert bytes(row.coded.decoded) == bytes(row.again) == text.encode()
    assert docs.limit(0).select(tokenizer.round_trip(F.col("text"))).count() == 0


def test_query_on_a_table(spark, both):
    from regline.llm.queries import op2_byte_bpe

    sf = "/root/testdata/sf0.001"
    _, usual = both
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in op2_byte_bpe(spark, sf).collect():
        ids = usual.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
