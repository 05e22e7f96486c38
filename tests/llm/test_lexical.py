"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest
from plain import ascii_lower

from regline.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "doc_id bigint, text string, terms string, score int"
ITEMS = "item_id bigint, text string"


def terms(text):
    return TERM.findall(ascii_lower(text or ""))


def plain(docs, items, top):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, words = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = set()
    for item, text in items:
        found = []
        for ident, bag in bags:
            m = 50 + (50 * sum(bag.values()) * n_docs) // words if words else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in set(terms(text)) if bag[t]
            )
            if score > 0:
                found.append((-score, ident is None, ident or 0, ident))
        out |= {(item, rank, ident, -score) for rank, (score, _, _, ident) in enumerate(sorted(found, key=lambda f: f[:3])[:top], 1)}
    return out


def tables(seed, n=700):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "日本語", "I'm", "x_y", "A1"]
    weights = [1 / (i + 1) for i in range(len(words))]

    def text(most):
        return rng.choice([" ", "-", ", "]).join(rng.choices(words, weights, k=rng.randrange(most)))

    docs = [(rng.choice([None, i, i // 2]) if i % 50 == 0 else i, text(40)) for i in range(n)]
    docs += [(5000 + i, "w1 w2 w3 same") for i in range(120)] + [(9000, None), (9001, ""), (9002, "w0 " * 30_000), (9003, " .!")]
    items = [(i, text(30)) for i in range(25)] + [(100, None), (101, ""), (102, "unheard of"), (103, "same w1"), (104, "W0 w0 w0")]
    return docs, items


@pytest.mark.parametrize("shard, block, at_once", [(1024, 64, 1000), (40, 4, 7), (1, 1, 1000)])
def test_equal_to_scoring_all(spark, monkeypatch, shard, block, at_once):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard)
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "ITEMS_AT_ONCE", at_once)
    docs, items = tables(shard)
    frame = spark.createDataFrame([(*d, "clash", 1) for d in docs], SCHEMA)
    asked = spark.createDataFrame(items, ITEMS)
    found = lexical.Index(frame, asked).search(asked, top=15)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    got = [tuple(r) for r in found.collect()]
    want = plain(docs, items, 15)
    assert len(got) == len(want) and set(got) == want


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "", 1)], SCHEMA), spark.createDataFrame([(1, "a")], ITEMS)
    for d, i in ((docs.where("false"), items), (docs, items.where("false")), (docs.selectExpr("doc_id", "null text"), items)):
        assert lexical.Index(d, i).search(i).collect() == []


def test_blocks_under_the_bound_are_skipped(spark, monkeypatch):
    import numpy as np

    rows = [{"id": i, "n": 3, "terms": ["both", f"t{i % 4}"], "tfs": [1 + i % 4, 2]} for i in range(400)]
    monkeypatch.setattr(lexical, "BLOCK", 20)
    row = lexical._Builder(400, 1200)._shard(rows).to_pylist()[0]
    shard = lexical._Shard(row, [(0, ["both", "t3"], [10, 500])])
    exact = shard.matrix[:, [row["terms"].index("both"), row["terms"].index("t3")]] @ np.array([10.0, 500.0])
    blocks, bounds = shard.bounds(0)
    for b, bound in zip(blocks.tolist(), bounds.tolist(), strict=True):  # never under a score in its block
        members = shard.members[shard.ends[b - 1] if b else 0 : shard.ends[b]]
        assert exact[members].max() <= bound
    threshold = np.sort(exact)[-50]
    assert 0 < (bounds >= threshold).sum() < len(bounds)
