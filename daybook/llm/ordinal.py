"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text is a set of hashed features (words, marks around words, its shape).  One weight vector is
shared by all grades; ordered thresholds cut the resulting score:
``P(grade > k) = sigmoid(score - threshold_k)``.  The sum of these is the expected grade, one
of them the tail probability that selects documents.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the feature hash: the model has 2^18 weights whatever the corpus.
FEATURE_BITS = 18
#: Rated documents the model is fitted on at most (those with the smallest hash of their id).
MAX_RATED = 16_384
#: Passes over them, step size and weight decay of the fit.
PASSES, STEP, DECAY = 8, 0.3, 1e-4
#: Features enter the fit if that many rated documents have them and their chi-square with the grades is that large.
LEAST_DOCUMENTS, LEAST_CHI_SQUARE = 4, 16.0
CACHE = 1 << 20
MARKS = string.punctuation + "“”„‘’«»…–—·•¿¡"


class Features(dict):
    """word -> numbers of its features, kept while a task runs (emptied when large)."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > CACHE:
            self.clear()
        core = word.strip(MARKS)
        names = [core] if core else []
        if (marks := word[len(word.rstrip(MARKS)) :]) and len(marks) > 1 or not core:
            names.append(f"\x01marks:{(marks or word)[:8]}")
        self[word] = found = tuple(feature(n) for n in names)
        return found

    def of(self, text: str) -> np.ndarray:
        """Sorted distinct feature numbers of a whole text."""
        words = text.lower().split()
        kinds = set(words)
        found = {i for w in kinds for i in self[w]}
        size = len(words)
        found.add(feature(f"\x01words:{size.bit_length()}"))
        found.add(feature(f"\x01distinct:{size.bit_length() // 3}:{10 * len(kinds) // max(size, 1)}"))
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        upper = int(((raw >= 65) & (raw <= 90)).sum())
        found.add(feature(f"\x01upper:{10 * upper // max(len(raw), 1)}"))
        return np.array(sorted(found), np.int64)


def feature(name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode("utf-8", "replace")) >> (64 - FEATURE_BITS)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def screened(rows: list[np.ndarray], grades: list[int], n_grades: int) -> np.ndarray:
    """Which features are spread over the grades otherwise than chance would have it."""
    have = np.zeros((n_grades, 1 << FEATURE_BITS))
    for row, grade in zip(rows, grades):
        have[grade, row] += 1
    size = np.bincount(grades, minlength=n_grades)[:, None]
    share = have.sum(axis=0) / max(size.sum(), 1)
    chi = ((have - size * share) ** 2 / np.maximum(size * share * (1 - share), 1e-9)).sum(axis=0)
    return (chi >= LEAST_CHI_SQUARE) & (have.sum(axis=0) >= LEAST_DOCUMENTS)


def fit(rows: list[np.ndarray], grades: list[int], n_grades: int, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by averaged stochastic gradient steps with a step size per weight.

    Thresholds are a first one and gaps kept positive by an exponential, so they stay ordered.
    """
    useful = screened(rows, grades, n_grades)
    rows = [row[useful[row]] for row in rows]
    weights, square = np.zeros(1 << FEATURE_BITS), np.full(1 << FEATURE_BITS, 1e-3)
    shares = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / max(len(grades), 1), 1e-3, 1 - 1e-3)
    start = np.log(shares / (1 - shares))
    cuts = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 1e-2))))
    cut_square, mean, mean_cuts, n = np.full(len(cuts), 1.0), np.zeros_like(weights), np.zeros_like(cuts), 0
    thresholds = lambda c: c[0] + np.concatenate(([0.0], np.cumsum(np.exp(c[1:]))))
    order = np.arange(len(rows))
    for turn in range(passes):
        np.random.default_rng(turn).shuffle(order)
        for i in order:
            x, k, theta = rows[i], grades[i], thresholds(cuts)
            score = weights[x].sum()
            a = sigmoid(theta[k] - score) if k < n_grades - 1 else 1.0
            b = sigmoid(theta[k - 1] - score) if k else 0.0
            slope = a + b - 1.0  # of the log likelihood by the score
            gradient = slope - DECAY * weights[x]
            square[x] += gradient * gradient
            weights[x] += STEP * gradient / np.sqrt(square[x])
            by_theta = np.zeros(len(cuts))
            if k < n_grades - 1:
                by_theta[k] += a * (1 - a) / max(a - b, 1e-9)
            if k:
                by_theta[k - 1] -= b * (1 - b) / max(a - b, 1e-9)
            tail = np.cumsum(by_theta[::-1])[::-1]
            by_cut = np.concatenate((tail[:1], tail[1:] * np.exp(cuts[1:])))
            cut_square += by_cut * by_cut
            cuts += STEP * by_cut / np.sqrt(cut_square)
        if turn >= passes // 2:
            mean, mean_cuts, n = mean + weights, mean_cuts + cuts, n + 1
    return (mean / n, thresholds(mean_cuts / n)) if n else (weights, thresholds(cuts))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in batches:
        listed = [features.of(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(listed, pa.list_(pa.int64()))], ["spot", "grade", "features"]
        )


def _fitted(batches: Iterator[pa.RecordBatch], n_grades: int) -> Iterator[pa.RecordBatch]:
    rows, grades = [], []
    for batch in batches:
        rows += [np.array(x, np.int64) for x in batch.column(2).to_pylist()]
        grades += batch.column(1).to_pylist()
    if rows:
        weights, thresholds = fit(rows, grades, n_grades)
        used = np.flatnonzero(weights)
        number = np.concatenate((-1 - np.arange(len(thresholds)), used))
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(np.concatenate((thresholds, weights[used])))], ["number", "value"])


def train(docs: DataFrame, ratings: DataFrame, n_grades: int, max_rated: int = MAX_RATED) -> tuple[np.ndarray, np.ndarray] | None:
    """(weights, thresholds) from ``ratings`` (doc_id, grade); None without any rated document.

    The sample is bounded by ``max_rated`` whatever the number of ratings; its features are made
    where the documents are, and one task fits the bounded rest.  A document rated more than once
    counts with its lowest grade; of rows that share a rated id the text with the smallest hash
    counts; null grades and ids are no ratings.
    """
    spot = F.xxhash64("doc_id")
    sample = (
        ratings.where("doc_id IS NOT NULL AND grade IS NOT NULL")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.least(F.greatest(F.min("grade"), F.lit(0)), F.lit(n_grades - 1)).cast("int").alias("grade"))
        .select(F.col("doc_id").alias("rated"), "grade", spot.alias("spot"))
        .orderBy("spot", "rated")
        .limit(max_rated)
    )
    rated = docs.join(F.broadcast(sample), F.col("doc_id").cast("bigint") == F.col("rated")).select(
        "spot", "rated", "grade", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    # one row per rated id, however often documents repeat it
    least = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    rated = rated.groupBy("spot", "rated", "grade").agg(least).drop("rated")
    features = rated.mapInArrow(_featured, "spot bigint, grade int, features array<bigint>")
    model = (
        features.repartition(1).sortWithinPartitions("spot", "features")
        .mapInArrow(partial(_fitted, n_grades=n_grades), "number bigint, value double")
    )
    rows = model.toPandas()
    if not len(rows):
        return None
    weights = np.zeros(1 << FEATURE_BITS)
    number, value = rows["number"].to_numpy(), rows["value"].to_numpy()
    weights[number[number >= 0]] = value[number >= 0]
    return weights, np.sort(value[number < 0])


def _graded(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    weights, thresholds = shared.value
    features = Features()
    for batch in batches:
        score = np.array([weights[features.of(t)].sum() for t in batch.column(1).to_pylist()], np.float64)
        tails = sigmoid(score[:, None] - thresholds[None, :])
        listed = pa.ListArray.from_arrays(np.arange(len(score) + 1, dtype=np.int32) * len(thresholds), pa.array(tails.ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(score), pa.array(tails.sum(axis=1)), listed], ["doc_id", "score", "expected_grade", "tails"]
        )


def graded(
    docs: DataFrame, ratings: DataFrame, n_grades: int = 3, tail: int = 2, least: float = 0.5, max_rated: int = MAX_RATED
) -> DataFrame:
    """(doc_id, score, expected_grade, tail_probability, selected), one row per row of ``docs``.

    tail_probability is P(grade >= ``tail``), and ``selected`` says whether it reaches ``least``.  Null
    texts count as empty; without any rating the figures are null and nothing is rejected; repeated rows
    come out as often as they came in; an empty table gives no rows; other columns
    are not looked at.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    model = train(docs, ratings, n_grades, max_rated)
    none = F.lit(None).cast("double")
    if model is None:
        return rows.select(
            "doc_id", none.alias("score"), none.alias("expected_grade"), none.alias("tail_probability"), F.lit(True).alias("selected")
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = rows.mapInArrow(
        partial(_graded, shared=shared), "doc_id bigint, score double, expected_grade double, tails array<double>"
    )
    chance = F.get("tails", F.lit(tail - 1)) if tail else F.lit(1.0)
    return out.select("doc_id", "score", "expected_grade", chance.alias("tail_probability"), (chance >= least).alias("selected"))


def ratings_of(labels: DataFrame) -> DataFrame:
    """Grades from two labels: 0 toxic, 1 neither toxic nor good, 2 good and not toxic; null if a label needed is null."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("toxic").isNotNull() & F.col("quality").isNotNull(), 1 + F.col("quality"))
    return labels.select("doc_id", grade.cast("int").alias("grade"))
