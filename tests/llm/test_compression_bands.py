"""Compression bands against encoded data, in long texts and short ones."""

import base64
import random

import pytest
import zstandard
from test_text_rules import rng_words

from regline.llm import compression

COMPRESSOR = zstandard.ZstdCompressor(level=compression.LEVEL)


def encoded(size, width=76, seed=3):
    rng = random.Random(seed)
    return "\n".join(base64.b64encode(rng.randbytes(width // 4 * 3)).decode() for _ in range(size // width + 1))[:size]


def judged(text):
    return dict(zip([f.split()[0] for f in compression.FIELDS.split(", ")], compression.judge_text(text, COMPRESSOR)))


def test_long_clean_text_with_a_base64_half():
    clean = rng_words(8000)[:50_000]
    assert judged(clean)["kept"]
    got = judged(clean + "\n" + encoded(50_000))
    assert not got["base_failed"] and got["largest_chunk_ratio"] > compression.CHUNK_LIMITS[1] and not got["kept"]
    assert compression.WHOLE_LIMITS[-1][1] < got["whole_ratio"] < compression.WHOLE_LIMITS[-1][2]


@pytest.mark.parametrize("size, width", [(4000, 76), (4096, 8), (2049, 8), (2048, 8), (1100, 8), (1024, 8), (700, 8), (512, 8), (470, 8)])
def test_base64_alone(size, width):
    got = judged(encoded(size, width))
    assert not got["base_failed"] and not got["kept"]


@pytest.mark.parametrize("n_clean, n_last", [(4096, 2004), (8192, 2047), (6000, 3000)])
def test_the_end_of_a_text_lies_in_a_judged_chunk(n_clean, n_last):
    clean = rng_words(4000)
    assert judged(clean[: n_clean + n_last])["kept"]
    tail = (clean[:n_clean] + encoded(n_last)).encode()
    _, _, largest = compression.ratios(tail, COMPRESSOR)
    assert largest == max(len(COMPRESSOR.compress(tail[a : a + 4096])) / 4096 for a in (*range(0, len(tail) - 4095, 4096), len(tail) - 4096))
    dull = judged(clean[:n_clean] + " " + "".join(" " + "a" * n for n in range(1, 200))[-n_last:])
    assert dull["least_chunk_ratio"] < compression.CHUNK_LIMITS[0] and not dull["kept"]


def test_clean_documents_stay(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1"), "doc_id"
    )
    results = [judged(r.text) for r in rows.select("text").collect()]
    assert results and all(r["kept"] or r["base_failed"] for r in results)
