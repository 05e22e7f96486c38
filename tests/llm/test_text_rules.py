"""Token counts, compression rules and sentence spans."""

import base64
import random

import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import sentence_repeats, words
from pyspark.sql import functions as F
from test_token_counts_whole import greedy as marked_greedy
from test_token_counts_whole import pieces  # noqa: F401

from regline.llm import compression, sentence_spans, wordpiece

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def greedy(word, first, rest, longest=20):
    at = pieces = 0
    while at < len(word):
        stop = next((j for j in range(min(len(word), at + longest), at, -1) if word[at:j] in (rest if at else first)), None)
        if stop is None:
            return 1
        at, pieces = stop, pieces + 1
    return pieces


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5)), st.sets(st.text("abc", min_size=1, max_size=4)), st.text("abcd", max_size=14))
def test_automaton_equals_greedy_search(first, rest, word):
    assert wordpiece.Automaton(first, rest).count(word) == greedy(word, first, rest)


def test_token_counts_of_a_table(spark, pieces):
    texts = ["", None, " \n", "unbelievable tokens, 日本語 café\x1cx", "z" * 30_000, "word " * 20_000, "🙂" * 5]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens int")
    counted = docs.select("doc_id", wordpiece.TokenCounter(spark, MODEL).count(F.col("text")).alias("c")).collect()
    want = [(len(words(t)), sum(marked_greedy(w, pieces, lambda c: len(c.encode())) for w in words(t))) for t in texts]
    assert [tuple(r.c) for r in sorted(counted)] == want


def plain_rules(text):
    found = words(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if words(line)]
    failed = len(found) < 50 or 100 * len(covered) > 50 * len(found)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered), failed


@settings(max_examples=200, deadline=None)
@given(st.text("ab é\n\x0b\x1c #|<", max_size=200))
def test_base_rules_equal_plain_ones(text):
    got = compression.judge_text(text, zstandard.ZstdCompressor(level=compression.LEVEL))
    assert (*got[:5], got[8]) == plain_rules(text)


def rng_words(n, seed=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(n))


def test_bands(spark):
    rng = random.Random(1)
    prose = rng_words(3000)
    noise = " ".join(base64.b85encode(rng.randbytes(9)).decode() for _ in range(2000))
    # Each word once or twice in a row, so no three words come back, yet the bytes hardly vary.
    dull = " ".join("a" * n for n in range(1, 400))
    texts = [prose, noise, dull, prose + " " + dull[:20000], prose + " " + noise, None, "", "x " * 100, prose * 1]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id bigint, text string, kept string")
    got = {r.doc_id: r.j for r in docs.select("doc_id", compression.judge(F.col("text")).alias("j")).collect()}
    assert [got[i].kept for i in range(len(texts))] == [True, False, False, False, False, False, False, False, True]
    assert [got[i].base_failed for i in range(len(texts))] == [False, False, False, False, False, True, True, True, False]
    # The whole of these two lies within its band; one of their chunks doesn't.
    assert compression.WHOLE_LIMITS[-2][1] < got[4].whole_ratio < compression.WHOLE_LIMITS[-2][2]
    assert got[3].least_chunk_ratio < compression.CHUNK_LIMITS[0] and got[4].largest_chunk_ratio > compression.CHUNK_LIMITS[1]
    assert docs.limit(0).select(compression.judge(F.col("text"))).count() == 0


def test_rules_query_against_plain_ones(spark):
    from regline.llm.queries import op8_compression_rules

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 6000").collect()}
    got = {r.doc_id: r for r in op8_compression_rules(spark, sf).collect()}
    for i, text in texts.items():
        r, data = got[i], text.encode()
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_rules(text)
        size = zstandard.ZstdCompressor(level=compression.LEVEL).compress(data)
        assert r.whole_ratio == pytest.approx(len(size) / len(data)) and not (r.kept and r.base_failed)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()
    assert all(got[r.doc_id].kept or got[r.doc_id].base_failed for r in labels)


@settings(max_examples=200, deadline=None)
@given(st.text("ab. !?\n\x1c", max_size=120))
def test_sentences_make_up_the_text(text):
    parts = sentence_spans.sentences(text)
    assert "".join(parts) == text or not words(text)
    assert all(words(part) for part in parts)


def planted():
    passage = rng_words(60, seed=7)  # without a stop
    stops = ". ".join(rng_words(9, seed=s) for s in range(8)) + "."
    rows = [(i, f"{rng_words(30 + i, seed=100 + i)}. Then {rng_words(12, seed=200 + i)}. {rng_words(8, seed=300 + i)}.") for i in range(8)]
    rows += [(20, rows[0][1] + " " + passage), (21, f"{rows[1][1]} before it {passage} after it"), (22, f"{stops}\n{stops}"), (23, f"intro\n{stops}")]
    return rows + [(30, None), (31, ""), (32, " \n "), (None, stops), (40, "OF!! THE!! " * 3000), (23, f"intro\n{stops}"), (50, "Yes. No. Yes.")], passage, stops


def test_spans_equal_brute_force_and_catch_planted_passages(spark):
    rows, passage, stops = planted()
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id bigint, text string, starts string, N_REMOVED int")
    cleaned = sentence_spans.remove_repeats(docs)
    assert cleaned.columns == [*docs.columns, "_n_removed"]
    last = 10**9  # null ids come last
    want = sentence_repeats({(last if i is None else i, t or "") for i, t in rows}, sentence_spans.sentences)
    got = cleaned.collect()
    assert len(got) == len(rows)
    for r in got:
        before = [t or "" for i, t in rows if i == r.doc_id]
        assert r.text in {want[last if r.doc_id is None else r.doc_id, t] if t.split() else t for t in before}
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].text == t and by_id[i]["_n_removed"] == 0 for i, t in rows[:8])
    assert passage in by_id[20].text and len(set(passage.split()) & set(by_id[21].text.split())) < 20
    assert by_id[22].text.count(stops[:40]) == 1 and stops[60:200] not in by_id[23].text and by_id[None].text == ""
    assert sentence_spans.remove_repeats(docs.limit(0)).count() == 0


def test_spans_query_equals_brute_force(spark):
    from regline.llm.queries import op9_sentence_spans

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: t for (i, _), t in sentence_repeats(set(rows), sentence_spans.sentences).items()}
    assert {r.doc_id: r.text for r in op9_sentence_spans(spark, sf).collect()} == want
