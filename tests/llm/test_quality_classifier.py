import numpy as np
import pytest
from pyspark.sql import functions as F

from regline.llm import quality_classifier as op

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    from regline.llm.queries import op1_quality_classifier

    scored = op1_quality_classifier(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    assert len(rows) > 80 and sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.99
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_scores_are_density_differences():
    """Against densities written out with inverses and determinants."""
    rng = np.random.default_rng(0)
    d = len(op.STATS)
    x = {k: rng.normal(k, 1 + k, (200 + 300 * k, d)) @ rng.normal(0, 1, (d, d)) for k in (0, 1)}
    n = np.array([len(x[0]), len(x[1])], float)
    sums = np.array([x[k].sum(axis=0) for k in (0, 1)])
    products = np.array([x[k].T @ x[k] for k in (0, 1)])
    model = op.from_moments(n, sums, products, 0.3, 0.05)
    both = np.concatenate([x[0], x[1]])
    scale = both.std(axis=0) + 1e-3
    z = {k: (x[k] - both.mean(axis=0)) / scale for k in (0, 1)}
    cov = {k: np.cov(z[k].T, bias=True) for k in (0, 1)}
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    points, log_density = (both[:50] - both.mean(axis=0)) / scale, []
    for k in (0, 1):
        own = 0.7 * cov[k] + 0.3 * pooled
        own = 0.95 * own + 0.05 * (np.trace(own) / d + 1e-6) * np.eye(d)
        away = points - z[k].mean(axis=0)
        mahalanobis = np.einsum("ij,jk,ik->i", away, np.linalg.inv(own), away)
        log_density.append(np.log((n[k] + 1) / (n.sum() + 2)) - 0.5 * np.linalg.slogdet(own)[1] - 0.5 * mahalanobis)
    want = 1 / (1 + np.exp(-np.clip((log_density[1] - log_density[0]) / d, -500, 500)))
    assert np.allclose(model.scores(both[:50]), want, atol=1e-9)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "a", 2.0) for i, t in rows], "doc_id bigint, text string, label string, score double")


def test_nulls_empty_and_long_texts_and_labels(spark):
    prose = "Here is a plain sentence with usual words in it. Another one follows, as they do. "
    rows = [(i, prose * (1 + i % 3)) for i in range(40)] + [(100 + i, "BUY!! NOW!! " * (5 + i)) for i in range(20)]
    rows += [(None, None), (None, "x"), (300, ""), (301, None), (302, prose * 20_000), (0, prose)]
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(20)] + [(3, 1), (5, None), (None, 1), (7, 9), (9, 0), (999, 0)]
    docs = documents(spark, rows)
    model = op.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    got = docs.select("doc_id", op.score(model, F.col("text")).alias("s")).collect()
    assert len(got) == len(rows) and all(0 <= r.s <= 1 for r in got)
    assert min(r.s for r in got if r.doc_id in range(40)) > 0.5 > max(r.s for r in got if r.doc_id in range(100, 120))
    kept = op.accepted(docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(r.s >= 0.5 for r in got)


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, 0)]])
def test_missing_classes(spark, labels):
    docs = documents(spark, [(1, "some text"), (2, "more text here"), (3, None)])
    model = op.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    scores = [r.s for r in docs.select(op.score(model, F.col("text")).alias("s")).collect()]
    assert all(0 <= s <= 1 for s in scores) and (labels or scores == [0.5] * 3)
    assert op.accepted(documents(spark, []), model).count() == 0


def test_training_rows_are_bounded(spark):
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    chosen = op.training_labels(labels, "doc_id", "quality", F.lit(True), 1000)
    assert 850 < chosen.count() < 1150
    assert op.training_labels(labels, "doc_id", "quality", ~op.held_out(F.col("doc_id")), 10**6).where(op.held_out(F.col("doc_id"))).count() == 0
