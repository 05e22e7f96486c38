"""Suffix arrays against sorting suffixes, and removal against comparing every string."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from regline.llm import suffix_dedup

SCHEMA = "doc_id bigint, text string, kept string, hash int"
LENGTH = suffix_dedup.LENGTH


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(min_size=1, max_size=200), st.text("ab\x00", min_size=1, max_size=300).map(str.encode)), st.integers(1, 4))
def test_suffix_order_and_common_prefixes(data, times):
    data = data * times
    codes = np.frombuffer(data, np.uint8)
    order = suffix_dedup.suffix_array(codes)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    common = suffix_dedup.common_prefixes(codes, order).tolist()
    padded = data + bytes(LENGTH)  # zeros past the end count
    for k in range(1, len(order)):
        a, b = (padded[order[i] :][:LENGTH] for i in (k - 1, k))
        assert common[k] == next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(1)
    passage = rng.integers(97, 123, LENGTH, dtype=np.uint8)
    found = set()
    for k in range(30):
        codes = np.concatenate([rng.integers(97, 123, 20 + k, dtype=np.uint8), passage, rng.integers(97, 123, 60, dtype=np.uint8)])
        hashes, starts, n = suffix_dedup.anchors(codes)
        assert starts.tolist() == (np.cumsum(n) - n).tolist() and n.sum() == len(codes) - LENGTH + 1
        found.add(int(hashes[np.searchsorted(starts, 20 + k, "right") - 1]))
    assert len(found) == 1


def plain(rows):
    """By (id, text): bytes kept, bytes removed, runs."""
    last = 1 << 63
    first, out = {}, {}
    for ident, text in rows:
        data = (text or "").encode()
        for j in range(len(data) - LENGTH + 1):
            first[data[j : j + LENGTH]] = min(first.get(data[j : j + LENGTH], last), last if ident is None else ident)
    for ident, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for j in range(len(data) - LENGTH + 1):
            if first[data[j : j + LENGTH]] < (last if ident is None else ident):
                gone[j : j + LENGTH] = b"\x01" * LENGTH
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(data)))
        out[ident, text] = bytes(c for c, g in zip(data, gone, strict=True) if not g), sum(gone), runs
    return out


def texts(seed):
    rng = random.Random(seed)

    def prose(n):
        return "".join(rng.choice("abcdefgh éü日\n. ") for _ in range(n))

    passages = [prose(n) for n in (49, 50, 51, 70, 200, 600)] + ["ab" * 60, "x" * 130, "\x00" * 90]
    rows = [(i, "".join(rng.choice(passages) if rng.random() < 0.5 else prose(rng.randrange(80)) for _ in range(rng.randrange(6)))) for i in range(150)]
    hot = prose(300)
    rows += [(1000 + i, prose(30) + hot + prose(30)) for i in range(60)] + [(2000 + i, hot * 2) for i in range(40)]
    rows += [(None, hot), (None, None), (7, "short"), (8, "short"), (3, hot), (3, prose(40) + hot), (3000, "z" * 30_000), (3001, "z" * 30_000), (3001, "z" * 30_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, shard_bytes", [(1, suffix_dedup.SHARD_BYTES), (2, 3000), (3, 100)])
def test_equal_to_comparing_all_strings(spark, seed, shard_bytes):
    rows = texts(seed)
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(7)
    cleaned = suffix_dedup.remove_repeats(docs, shard_bytes=shard_bytes)
    assert cleaned.columns == [*docs.columns, "_kept", "n_removed", "n_spans"]
    want = plain(rows)
    got = cleaned.collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == sorted((i or -1, t or "") for i, t in rows)
    for r in got:
        assert (bytes(r._kept), r.n_removed, r.n_spans) == want[r.doc_id, r.text], r.doc_id


def test_empty_table_and_query(spark):
    import hashlib

    from regline.llm.queries import op13_suffix_dedup

    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.remove_repeats(empty).collect() == []
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (len((t or "").encode()), gone, runs, hashlib.sha256(kept).hexdigest()) for (i, t), (kept, gone, runs) in plain(rows).items()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op13_suffix_dedup(spark, sf).collect()}
    assert got == want
