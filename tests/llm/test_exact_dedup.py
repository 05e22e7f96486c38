import hashlib

from regline.llm import exact_dedup

SCHEMA = "doc_id bigint, text string, digest string, kept boolean"


def judged(spark, rows, index=None, name=None):
    docs = spark.createDataFrame([(*r, "x", True) for r in rows], SCHEMA)
    return exact_dedup.dedup_batch(docs, index or exact_dedup.open_index(spark), name=name).collect()


def test_largest_id_stays_and_null_counts_as_empty(spark):
    got = judged(spark, [(1, "a"), (5, "a"), (3, "a"), (2, None), (4, ""), (6, "A"), (7, " a")])
    assert {(r.id, r.keep_id, r.group_size, r.kept) for r in got} == {
        (1, 5, 3, False), (5, 5, 3, True), (3, 5, 3, False), (2, 4, 2, False), (4, 4, 2, True), (6, 6, 1, True), (7, 7, 1, True),
    }
    assert {bytes(r.digest).hex() for r in got if r.id in (2, 4)} == {hashlib.sha256(b"").hexdigest()}


def test_repeated_rows_null_ids_and_empty_tables(spark):
    got = judged(spark, [(1, "a")] * 3 + [(None, "b")] * 2 + [(None, "c"), (9, "c")])
    assert sum(r.kept for r in got) == 3 and len(got) == 7
    assert [r.keep_id for r in got if r.kept and r.id is None] == [None]
    assert judged(spark, []) == []


def test_later_batches_meet_the_index_and_it_can_be_reopened(spark, tmp_path):
    where = str(tmp_path / "index")
    first = exact_dedup.open_index(spark, location=where, buckets=3)
    assert all(r.kept for r in judged(spark, [(1, "a"), (2, "b")], first))
    again = exact_dedup.open_index(spark, location=where, buckets=3)
    got = judged(spark, [(7, "a"), (8, "c"), (9, "c")], again)
    assert {(r.id, r.keep_id, r.kept) for r in got} == {(7, 1, False), (8, 9, False), (9, 9, True)}
    spark.catalog.refreshTable(first)
    assert spark.table(first).count() == 3


def test_kept_rows_have_all_columns(spark):
    rows = [(1, "a", "x", True), (1, "a", "y", False), (2, None, "z", None), (None, "q", "w", True), (3, "long " * 50_000, "v", True)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = exact_dedup.keep_first_copies(docs, exact_dedup.open_index(spark))
    assert kept.schema == docs.schema
    got = [tuple(r) for r in kept.collect()]
    assert len(got) == 4 and set(got) <= set(rows) and {r[0] for r in got} == {1, 2, 3, None}


def test_anti_join_does_not_shuffle_the_index(spark):
    index = exact_dedup.open_index(spark, buckets=8)
    judged(spark, [(i, str(i)) for i in range(50)], index)
    new = spark.createDataFrame([(str(i),) for i in range(9)], "text string").select(exact_dedup.digest(exact_dedup.F.col("text")).alias("digest"))
    joined = new.hint("merge").join(spark.table(index).select("digest").hint("merge"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_a_batch_run_again_under_its_name_is_judged_as_before(spark, monkeypatch):
    index = exact_dedup.open_index(spark, buckets=3)
    judged(spark, [(1, "a"), (2, "b")], index, "monday")
    rows = [(7, "a"), (8, "c"), (9, "c"), (3, "d"), (4, None)]
    docs = spark.createDataFrame([(*r, "x", True) for r in rows], SCHEMA)
    # The job ends behind the append: its result is never read.
    exact_dedup.dedup_batch(docs, index, name="tuesday")
    want = {(7, 1, False), (8, 9, False), (9, 9, True), (3, 3, True), (4, 4, True)}
    for _ in range(2):
        assert {(r.id, r.keep_id, r.kept) for r in judged(spark, rows, index, "tuesday")} == want
    assert exact_dedup.keep_first_copies(docs, index, name="tuesday").count() == 3
    assert spark.table(index).count() == 5
    # And before the append, when the judgement is written but the index is not.
    def fails(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr("pyspark.sql.classic.dataframe.DataFrame.repartition", fails)
        try:
            judged(spark, [(20, "e")], index, "wednesday")
        except RuntimeError:
            pass
    assert [tuple(r)[2:] for r in judged(spark, [(20, "e")], index, "wednesday")] == [(20, 1, True)]
    assert {(r.id, r.kept) for r in judged(spark, [(30, "e"), (31, "a")], index, "thursday")} == {(30, False), (31, False)}


def test_buckets_are_compacted_to_one_sorted_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "COMPACT_FILES", 3)
    where = str(tmp_path / "index")
    index = exact_dedup.open_index(spark, location=where, buckets=2)
    for k in range(5):
        got = judged(spark, [(100 * k + i, f"text {i + 5 * k}") for i in range(40)], index, str(k))
        assert sum(r.kept for r in got) == (40 if k == 0 else 5)
        assert len(spark.table(index).inputFiles()) < 3 * 2 + 2  # compacted before the append
    reopened = exact_dedup.open_index(spark, location=where, buckets=2)
    assert spark.table(reopened).count() == 60
    exact_dedup.compact(spark, reopened)
    assert len(spark.table(reopened).inputFiles()) == 2 and spark.table(reopened).count() == 60
    new = spark.createDataFrame([(b"x",)], "digest binary")
    joined = new.hint("merge").join(spark.table(reopened).select("digest").hint("merge"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    # Neither an exchange nor a sort on the side of the index.
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
