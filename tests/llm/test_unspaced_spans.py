"""Sentence spans in scripts written without spaces."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from regline.llm import sentence_spans


def unspaced(n, seed, stops="", first=0x4E00):
    rng = random.Random(seed)
    return "".join(rng.choice(stops) if stops and i % 12 == 11 else chr(first + rng.randrange(80)) for i in range(n))


def test_copies_without_spaces_are_removed(spark):
    page, plain, thai = unspaced(300, 1, "。！？"), unspaced(400, 2), unspaced(400, 3, first=0x0E01)
    lines = "\n".join(unspaced(30, s) for s in range(20, 25))
    rows = {1: page, 2: page + " ", 3: plain, 4: unspaced(50, 4) + plain + unspaced(50, 5), 5: thai, 6: "x " + thai, 7: lines, 8: "题\n" + lines}
    rows |= {9: "你好。再见。谢谢。", 10: "你好。再见。谢谢。" + unspaced(60, 6), 11: unspaced(200, 7, "。")}
    docs = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    got = {r.doc_id: r for r in sentence_spans.remove_repeats(docs, total="n_sentences").collect()}
    assert all(got[i].text == rows[i] and got[i].n_removed == 0 for i in (1, 3, 5, 7, 9, 10, 11))
    assert got[2].text == "" and got[2].n_removed == got[2].n_sentences == 25
    # Only what is cut together with words of its own stays beside them.
    assert len(got[4].text) < 250 and len(got[6].text) < 100 and got[8].text == "题\n"


@settings(max_examples=300, deadline=None)
@given(st.text("ab. !?\n日本。！ก𠀀é’", max_size=150))
def test_sentences_make_up_mixed_text(text):
    parts = sentence_spans.sentences(text)
    assert "".join(parts) == text or not text.strip(" \n")
    assert all(part.strip(" \n") for part in parts)
