import random

import pytest
from plain import targets, words
from pyspark.sql import functions as F

from regline.llm import mixing as op


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id bigint, text string, source string, size string, target int")


def some(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["b", "b", "b", "a", "é", "Z", "", None, "tiny"])
        size = rng.choice([0, 1, 3, 10, 200]) if source != "tiny" else 1
        rows.append((i, rng.choice(["w ", "#$ w\n", "é\t"]) * size if rng.random() < 0.97 else None, source))
    return rows


def test_counts_equal_a_plain_mix(spark):
    rows = some()
    docs = docs_of(spark, rows)
    got = {r.id: r for r in op.mixed_counts(docs).collect()}
    keys = {r.doc_id: r.key for r in docs.select("doc_id", op.sampling_key(F.col("doc_id"), F.col("text"), op.quality_weight(F.col("text"))).alias("key")).collect()}
    order = sorted({s for _, _, s in rows if s is not None}, key=lambda s: s.encode()) + [None]
    members = {s: [(keys[i], len(words(t)), i) for i, t, x in rows if x == s] for s in order}
    sizes = [sum(n for _, n, _ in members[s]) for s in order]
    for source, size, target in zip(order, sizes, targets(sizes)):
        epochs = int(target // size) if size else 0
        rest, so_far = target - epochs * size, 0
        for key, n, i in sorted(members[source]):
            more = rest > 0 and so_far + n / 2 <= rest
            so_far += n
            assert got[i].source_size == size and got[i].target == pytest.approx(target)
            assert (got[i].size, got[i].taken) == (n, n * (epochs + more)), (source, key)
    assert len(got) == len(rows)


def test_reruns_and_the_mix_itself_agree(spark):
    rows = some(2, 120)
    docs = docs_of(spark, rows)
    one, two = ({r.id: r.taken for r in op.mixed_counts(d).collect()} for d in (docs, docs.repartition(5)))
    assert one == two
    mixed = op.mix(docs)
    assert mixed.schema == docs.schema
    counts = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert all(counts.get(i, 0) * len(words(t)) == one[i] for i, t, _ in rows)


def test_odd_tables(spark):
    assert op.mixed_counts(docs_of(spark, [])).count() == op.mix(docs_of(spark, [])).count() == 0
    only_empty = op.mixed_counts(docs_of(spark, [(1, "", "a"), (2, None, None), (None, " \n", "a")])).collect()
    assert [(r.size, r.target, r.taken) for r in only_empty] == [(0, 0.0, 0)] * 3
    same = op.mixed_counts(docs_of(spark, [(1, "a b c", "s")] * 10 + [(None, "w " * 90_000, "s")])).collect()
    assert len(same) == 11 and len({r.taken for r in same if r.size == 3}) == 1
    assert all(r.taken <= 2 * r.size for r in same)


def test_places_follow_code_points_with_null_last(spark):
    names = ["b", "a", "B", "", "é", "z", "ｚ", "😀", None, *[f"s{i}" for i in range(40)]]
    rows = spark.createDataFrame([(n, 1) for n in names], "source string, source_size bigint")
    got = {r.source: r.place for r in op.ranked(rows).collect()}
    order = sorted((n for n in names if n is not None), key=lambda n: n.encode()) + [None]
    assert got == {n: i for i, n in enumerate(order)}
