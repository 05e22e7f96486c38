"""Collocations against counting every phrase."""

import random
import re
from collections import Counter

import pytest
from plain import ascii_lower

from regline.llm import collocations

SCHEMA = "lang string, text string, rank string"


def plain(rows, min_count, max_words=5, top=2000, covered=100):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", ascii_lower(text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, *words[i : i + k]) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
    phrases = {p: a for p, a in counts.items() if len(p) > 2 and a >= min_count}
    inside = {
        (p[0], *p[1 + i : 1 + i + k])
        for p, around in phrases.items() for k in range(2, len(p) - 1) for i in range(len(p) - k)
        if 100 * around >= covered * counts[(p[0], *p[1 + i : 1 + i + k])]
    }
    out = {}
    for p, a in phrases.items():
        if p in inside:
            continue
        lang, words, n = p[0], p[1:], totals[p[0]]
        cuts = [(counts[(lang, *words[:k])], counts[(lang, *words[k:])]) for k in range(1, len(words))]
        score, _, l, r = min((1000 * a * n // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return {
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, found in out.items() for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1)
    }


def rows_of(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "b", "çé", "x\x00y", "the", "日本", "﻿", "z'z"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!?"]
    out = [(rng.choice(["en", "fr", None]), "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(40)))) for _ in range(n)]
    return out + [("en", None), (None, ""), ("en", "the the the the the the the"), ("", "a b " * 3000), ("en", ". , ;")]


@pytest.mark.parametrize("seed, group", [(1, 1 << 20), (2, 30), (3, 1)])
def test_equal_to_counting_every_phrase(spark, seed, group):
    rows = rows_of(seed)
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = collocations.collocations(docs, min_count=4, top=40, group_leaves=group)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == plain(rows, 4, top=40)


def test_prefixes_that_the_bitmap_takes_for_split_ones(spark, monkeypatch):
    class Crowded(collocations.Bitmap):
        """So few bits that most values are taken for members."""

        def __init__(self, members, value):
            super().__init__(members, value)
            self.few = self.size >> 14

        def has(self, values):
            bits = self._bits.value.reshape(-1)
            folded = [any(bits[i * len(bits) // self.few : (i + 1) * len(bits) // self.few]) for i in range(self.few)]
            return super().has(values) | [folded[int(v) % self.few] for v in values]

    rows = rows_of(5)
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(collocations, "Bitmap", Crowded)
        got = {tuple(r) for r in collocations.collocations(docs, min_count=4, top=40, group_leaves=20).collect()}
    assert got == plain(rows, 4, top=40)


def test_covered_share_and_fewer_words(spark):
    rows = rows_of(7)
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = collocations.collocations(docs, min_count=3, max_words=3, covered=60)
    assert {tuple(r) for r in got.collect()} == plain(rows, 3, max_words=3, covered=60)


def test_empty_table_and_nothing_frequent(spark):
    for rows in ([], [("en", "once only", "")], [(None, None, None)]):
        assert collocations.collocations(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_scores_pass_64_bits(spark):
    a, n, l, r = 10**12, 10**13, 2 * 10**12, 10**12
    row = spark.createDataFrame([(a, n, l, r)], "a bigint, n bigint, l bigint, r bigint")
    exact = {c: f"CAST({c} AS DECIMAL(15, 0))" for c in "alrn"}
    score = row.selectExpr(f"CAST(1000 AS DECIMAL(4, 0)) * {exact['a']} * {exact['n']} div ({exact['l']} * {exact['r']}) AS s").first().s
    assert score == 1000 * a * n // (l * r)
