"""Sentences a text had, beside those removed from it."""

from regline.llm import sentence_spans


def test_query_counts_the_sentences_of_each_text(spark):
    from regline.llm.queries import op9_sentence_spans

    sf = "/root/testdata/sf0.001"
    had = {r.doc_id: len(sentence_spans.sentences(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op9_sentence_spans(spark, sf)
    assert got.columns == ["doc_id", "text", "n_sentences", "n_removed"]
    rows = got.collect()
    assert {r.doc_id: r.n_sentences for r in rows} == had
    assert any(r.n_removed for r in rows) and all(0 <= r.n_removed <= r.n_sentences for r in rows)


def test_counts_of_null_and_blank_texts_and_taken_names(spark):
    rows = [(1, None, 7), (2, "", 7), (3, " \n ", 7), (4, "Yes. No. Yes.", 7), (5, "é ça! Was? Ja", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, N_SENTENCES int")
    got = sentence_spans.remove_repeats(docs, total="n_sentences")
    assert got.columns == [*docs.columns, "_n_sentences", "n_removed"]
    assert {r.doc_id: (r["_n_sentences"], r.n_removed) for r in got.collect()} == {1: (0, 0), 2: (0, 0), 3: (0, 0), 4: (3, 0), 5: (3, 0)}
