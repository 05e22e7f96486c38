"""Registered queries next to their SQL, and the pipeline next to a plain version."""

import duckdb
import public_tokenizers
import pytest
import tiktoken
from plain import near_groups, simhash, targets, words
from pyspark.sql import functions as F

import corpus_pipeline
from regline.llm import bpe, mixing, quality_classifier
from regline.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equal_to_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(repr, want))


def test_all_thirteen_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stored_simhash_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [simhash(r.text) for r in rows]
    want = {r.doc_id: (f"{fp:016x}", rows[g].doc_id) for r, fp, g in zip(rows, fps, near_groups(fps))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash_near_dedup"](spark, SF).collect()} == want


def test_pipeline_equals_a_plain_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_classifier.fit(docs, labels, usable=~quality_classifier.held_out(F.col("doc_id")))
    key = mixing.sampling_key(F.col("doc_id"), F.col("text"), mixing.quality_weight(F.col("text")))
    rows = [(r.doc_id, r.text, r.source, r.key) for r in docs.withColumn("key", key).collect()]

    stats = quality_classifier.np.array([quality_classifier.document_stats(t) for _, t, _, _ in rows])
    kept = [r for r, s in zip(rows, model.scores(stats)) if s >= 0.5]
    assert 0 < len(kept) < len(rows)
    kept = sorted({t: (i, t, s, k) for i, t, s, k in sorted(kept)}.values())  # the largest id of each text
    near = near_groups([simhash(t) for _, t, _, _ in kept])
    kept = [r for i, r in enumerate(kept) if near[i] == i]
    order = sorted({s for _, _, s, _ in kept})
    members = [sorted((k, len(words(t)), i, t) for i, t, s, k in kept if s == source) for source in order]
    sizes = [sum(n for _, n, _, _ in m) for m in members]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    usual = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for own, size, target in zip(members, sizes, targets(sizes)):
        epochs, so_far = int(target // size), 0
        for _, n, i, text in own:
            copies = epochs + (target - epochs * size > 0 and so_far + n / 2 <= target - epochs * size)
            so_far += n
            want += [(i, len(usual.encode_ordinary(text)))] * copies
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.n_tokens) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_on_odd_documents(spark, name, stage):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, fp bigint, score double"
    rows = [(1, "a", None, None, None, "x", 1, 1.0)] * 2 + [(None,) * 8, (2, "", "en", "s", 0, None, None, None), (3, "word " * 20_000, "", "s", 9, "", 0, 0.0)]
    docs = spark.createDataFrame(rows, schema)
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns and set(map(tuple, out.collect())) <= set(rows)
    assert stage(spark, docs.limit(0), SF).count() == 0
