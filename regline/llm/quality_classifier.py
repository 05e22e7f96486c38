"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a vector of transformed statistics. Per class a mean and a
covariance, shrunk towards the pooled covariance and then towards a multiple
of the identity, are fitted from moments that Spark sums. The score is the
logistic of the difference of the classes' Mahalanobis log densities, with the
Cholesky factors computed once.
"""

from __future__ import annotations

import math
import operator
import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regline.llm.common import text_or_empty, with_python

#: The model is fitted on about this many labelled rows, chosen by a hash of the id.
MAX_TRAINING_ROWS = 50_000
#: Weight of the pooled covariance in each class's covariance.
TO_POOLED = 0.5
#: Weight of the scaled identity in each class's covariance.
TO_IDENTITY = 0.01

STATS = (
    "words", "upper", "digits", "spaces", "punctuation", "symbols", "bars", "exclamations",
    "repeated_words", "stuttered_words", "repeated_pairs", "repeated_lines", "word_length",
)

UPPER, LETTER, DIGIT, SPACE, PUNCTUATION, SYMBOL, BAR, EXCLAMATION, OTHER = range(9)


@cache
def character_classes() -> np.ndarray:
    """The class of each code point, from its Unicode category."""
    by_category = {"L": LETTER, "M": LETTER, "N": DIGIT, "Z": SPACE, "P": PUNCTUATION, "S": SYMBOL}
    table = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))
        table[point] = UPPER if category in ("Lu", "Lt") else by_category.get(category[0], OTHER)
    table[[9, 10, 11, 12, 13]] = SPACE
    table[[ord(c) for c in "#*%&@_\\{}[]"]] = SYMBOL  # Unicode calls these punctuation
    table[ord("|")], table[ord("!")] = BAR, EXCLAMATION
    return table


def document_stats(text: str) -> list[float]:
    """One value per name in STATS; all shares are damped for short texts, so an empty text has zeros."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(character_classes()[points], minlength=OTHER + 1)
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = max(len(words) - 1, 0)
    letters = int(kinds[UPPER] + kinds[LETTER])

    def share(part, whole, damp):
        return math.log1p(100 * part / (whole + damp))

    return [
        math.log1p(len(words)),
        share(kinds[UPPER], letters, 20),
        *(share(kinds[k], len(points), 50) for k in (DIGIT, SPACE, PUNCTUATION, SYMBOL, BAR, EXCLAMATION)),
        math.sqrt((len(words) - len(set(words))) / (len(words) + 20)),
        share(sum(map(operator.eq, words, words[1:])), len(words), 20),
        share(pairs - len(set(zip(words, words[1:], strict=False))), pairs, 20),
        math.sqrt((len(lines) - len(set(lines))) / (len(lines) + 3)),
        math.log1p(letters / (len(words) + 1)),
    ]


def _stats_matrix(texts: pa.Array) -> np.ndarray:
    return np.array([document_stats(t or "") for t in texts.to_pylist()], float).reshape(-1, len(STATS))


@dataclass(frozen=True)
class Discriminant:
    """Per class 0 and 1: mean and lower Cholesky factor of the scaled statistics, log of prior over volume."""

    centre: np.ndarray
    scale: np.ndarray
    classes: tuple[tuple[np.ndarray, np.ndarray, float], ...]

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """Between 0 and 1. The log density difference is divided by the number of
        statistics before the logistic, which keeps the order and 0.5 and avoids saturation."""
        z = (stats - self.centre) / self.scale
        density = [
            constant - 0.5 * np.square(np.linalg.solve(factor, (z - mean).T)).sum(axis=0)
            for mean, factor, constant in self.classes
        ]
        tempered = np.clip((density[1] - density[0]) / len(STATS), -500, 500)
        return 1 / (1 + np.exp(-tempered))


def training_labels(labels: DataFrame, id_col: str, label_col: str, usable: Column, max_rows: int) -> DataFrame:
    """Distinct (id, 0/1 label) rows for which ``usable`` holds: all, or about ``max_rows`` chosen by a hash of the id."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & usable)
    known = known.select(id_col, F.col(label_col).cast("int").alias("label")).distinct()
    fraction = min(1.0, max_rows / max(1, known.count()))
    place = F.pmod(F.xxhash64(F.lit("training row"), F.col(id_col)), F.lit(1 << 30)) / (1 << 30)
    return known.where(place < fraction)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    usable: Column | None = None,
    max_rows: int = MAX_TRAINING_ROWS,
    to_pooled: float = TO_POOLED,
    to_identity: float = TO_IDENTITY,
) -> Discriminant:
    """Fit on the documents that have a usable label.

    The chosen ids number about ``max_rows`` at any input size, so they are
    broadcast and the texts are not shuffled. An id labelled both ways counts
    under both. Null texts count as empty. A class without rows takes the
    pooled moments and a prior from add-one counts; with no rows at all every
    score is 0.5.
    """
    with_python(docs)
    chosen = training_labels(labels, id_col, label_col, F.lit(True) if usable is None else usable, max_rows)
    stats = F.arrow_udf(lambda texts: pa.array(list(_stats_matrix(texts)), pa.list_(pa.float64())), "array<double>")
    x = [F.col("x")[i] for i in range(len(STATS))]
    upper = [(i, j) for i in range(len(STATS)) for j in range(i, len(STATS))]
    moments = (
        docs.select(id_col, text_or_empty(F.col(text_col)).alias("doc_text"))
        .join(F.broadcast(chosen), id_col)
        .select("label", stats("doc_text").alias("x"))
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(c) for c in x]).alias("sums"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in upper]).alias("products"),
        )
        .collect()  # two rows at most
    )
    d = len(STATS)
    n, sums, products = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for row in moments:
        n[row.label], sums[row.label] = row.n, row.sums
        for (i, j), value in zip(upper, row.products, strict=True):
            products[row.label, i, j] = products[row.label, j, i] = value
    return from_moments(n, sums, products, to_pooled, to_identity)


def from_moments(n, sums, products, to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> Discriminant:
    """The model of two classes' counts, sums and sums of products."""
    d = sums.shape[1]
    centre = sums.sum(axis=0) / max(n.sum(), 1)
    spread = np.diag(products.sum(axis=0)) / max(n.sum(), 1) - centre**2
    scale = np.sqrt(np.maximum(spread, 0)) + 1e-3
    means, scatters = [], []
    for k in (0, 1):
        mean = sums[k] / n[k] if n[k] else centre
        means.append((mean - centre) / scale)
        scatters.append((products[k] - n[k] * np.outer(mean, mean)) / np.outer(scale, scale))
    pooled = sum(scatters) / n.sum() if n.sum() else np.eye(d)
    classes = []
    for k in (0, 1):
        own = scatters[k] / n[k] if n[k] > 1 else pooled
        cov = (1 - to_pooled) * own + to_pooled * pooled
        cov = (1 - to_identity) * cov + to_identity * (np.trace(cov) / d + 1e-6) * np.eye(d)
        factor = np.linalg.cholesky((cov + cov.T) / 2)
        prior = math.log((n[k] + 1) / (n.sum() + 2))
        classes.append((means[k], factor, prior - float(np.log(np.diag(factor)).sum())))
    return Discriminant(centre, scale, tuple(classes))


def score(model: Discriminant, text: Column) -> Column:
    """Quality score of a text column, 0 to 1; a null text scores as an empty one."""
    udf = F.arrow_udf(lambda texts: pa.array(model.scores(_stats_matrix(texts)), pa.float64()), "double")
    return udf(text_or_empty(text))


def accepted(docs: DataFrame, model: Discriminant, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores at least ``threshold``, unchanged."""
    with_python(docs)
    return docs.where(score(model, F.col(text_col)) >= threshold)


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))
