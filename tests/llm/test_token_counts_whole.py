"""Token counts of words that begin with no marked piece, or hold characters outside the vocabulary."""

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import words
from pyspark.sql import functions as F

from regline.llm import wordpiece

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    """The unreduced vocabulary: marked and bare pieces, the bare mark among them."""
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}


def greedy(word, pieces, spelled, longest=20):
    word, at, found = "▁" + word, 0, 0
    while at < len(word):
        stop = next((j for j in range(min(len(word), at + longest), at, -1) if word[at:j] in pieces), None)
        found += 1 if stop else spelled(word[at])
        at = stop or at + 1
    return found


def test_digits_accents_cjk_and_bytes(spark, pieces):
    # Counts of sentencepiece itself, where each cut is without choice.
    texts = {"2024": 5, "3.14": 5, "1st": 3, "2024-01-01": 11, "ß": 2, "日本語": 4, "🙂🙂": 3, "Ａ": 4, "日" * 1000: 1001, "": 0}
    texts |= dict.fromkeys(["ñandú ça 12x café\x1cx", "中文文本没有空格。下一句", "▁a a▁b ▁▁▁", "퟿\U0010ffff x"], None)
    rows = list(texts)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    counted = docs.select("doc_id", wordpiece.TokenCounter(spark, MODEL).count(F.col("text")).alias("c")).collect()
    for r in counted:
        text = rows[r.doc_id]
        want = sum(greedy(w, pieces, lambda c: len(c.encode())) for w in words(text))
        assert tuple(r.c) == (len(words(text)), want)
        assert texts[text] in (None, want)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("▁abc", min_size=1, max_size=5)), st.text("▁abcdé", min_size=1, max_size=14), st.booleans())
def test_marked_words_equal_greedy_search(pieces, word, in_bytes):
    spelled = (lambda c: len(c.encode())) if in_bytes else (lambda c: 1)
    assert wordpiece.Automaton(pieces, pieces, spelled).count("▁" + word) == greedy(word, pieces, spelled)


def test_counts_follow_the_length_of_unspaced_documents(spark, pieces):
    from regline.llm.queries import op7_token_counts

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    known = {w: greedy(w, pieces, lambda c: len(c.encode())) for w in {w for t in texts.values() for w in words(t)}}
    got = op7_token_counts(spark, sf).collect()
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in got} == {i: (len(words(t)), sum(map(known.get, words(t)))) for i, t in texts.items()}
