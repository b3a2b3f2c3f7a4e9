"""Quality classifier: cumulative-link regression on graded ratings.

A text's features are its distinct words, hashed, and the bins of a few measures of its
form. One weight vector scores a text; ordered thresholds cut the score into grades,
P(grade <= k) = logistic(threshold_k - score). The expected grade orders texts, the tail
probability P(grade >= k) selects them.

Fitting uses a bounded sample of the rated rows (``max_rated``, smallest hash of doc_id
first) and gradients that Spark sums over it; scoring reads every text.

Texts that are null or empty are scored by their form alone. Rows of ratings without
doc_id or grade are left out; of several ratings of one document the lowest counts.
Without any rated document every weight is 0 and every text has the top grade. Null or
repeated doc_ids stay rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import LOWER, byte_class, find_words, prefix_sums, slices, span_hash, stored

WORD_BITS = 18
MEASURES = 8
BINS = 16
SIZE = (1 << WORD_BITS) + MEASURES * BINS
MAX_RATED = 20_000
LEAST_TEXTS = 10
PARTS = 8
STEPS = 100
RATE = 0.05
SHRINK = 1e-3

_WORD = byte_class((48, 57), (65, 90), (97, 122), (128, 255))
_UPPER = byte_class((65, 90))
_DIGIT = byte_class((48, 57))
_SPACE = byte_class((9, 13), (32, 32))
_MARK = ~(_WORD | _SPACE)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature number) of every feature a text has, each once, sorted by row."""
    rows = len(offsets) - 1
    lowered = LOWER[data]
    start, end, row = find_words(lowered, offsets, _WORD)
    hashes = span_hash(prefix_sums(lowered), start, end)
    word = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    words = np.unique(row * SIZE + word)

    size = np.maximum(np.diff(offsets), 1)
    total = np.maximum(np.bincount(row, minlength=rows), 1)
    of_class = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[data])])[offsets])
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    measures = [
        of_class(_UPPER) / size,
        of_class(_MARK) / size,
        of_class(_DIGIT) / size,
        of_class(_SPACE) / size,
        np.bincount(row, weights=again, minlength=rows) / total,
        1 - np.bincount(words // SIZE, minlength=rows) / total,
        np.bincount(row, weights=end - start, minlength=rows) / total / 16,
        np.log2(total + 1) / 16,
    ]
    binned = [
        np.arange(rows) * SIZE + (1 << WORD_BITS) + k * BINS + np.minimum((np.sqrt(m) * BINS).astype(np.int64), BINS - 1)
        for k, m in enumerate(measures)
    ]
    keys = np.sort(np.concatenate([words, *binned]))
    return keys // SIZE, keys % SIZE


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. (rows x thresholds)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, feature = features(data, offsets)
        return np.bincount(row, weights=self.weights[feature], minlength=len(offsets) - 1)


def gradient(model: OrdinalModel, grade: np.ndarray, row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the negative log likelihood, by weights and by thresholds."""
    score = np.bincount(row, weights=model.weights[feature], minlength=len(grade))
    below = 1 - model.above(score)
    edge = np.hstack([np.zeros((len(grade), 1)), below, np.ones((len(grade), 1))])
    slope = np.hstack([np.zeros((len(grade), 1)), below * (1 - below), np.zeros((len(grade), 1))])
    at = np.arange(len(grade))
    chance = np.maximum(edge[at, grade + 1] - edge[at, grade], 1e-12)
    upper, lower = slope[at, grade + 1] / chance, slope[at, grade] / chance
    by_threshold = np.zeros((len(grade), len(model.thresholds) + 2))
    by_threshold[at, grade + 1] -= upper
    by_threshold[at, grade] += lower
    by_weight = np.bincount(feature, weights=(upper - lower)[row], minlength=len(model.weights))
    return by_weight, by_threshold[:, 1:-1].sum(axis=0)


def rated_sample(documents: DataFrame, ratings: DataFrame, max_rated: int) -> DataFrame:
    """text and grade of at most ``max_rated`` rated documents."""
    grades = ratings.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rated)
    # At most `max_rated` rows of two numbers.
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "grade")


def fit(documents: DataFrame, ratings: DataFrame, top: int, max_rated: int = MAX_RATED, steps: int = STEPS) -> OrdinalModel:
    """Fit to ``ratings`` (doc_id, grade from 0 to ``top``). Repeated documents count as often as they stand."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in slices(batch.column(0)):
                row, feature = features(data, offsets)
                bounds = np.searchsorted(row, np.arange(end - at + 1)).astype(np.int32)
                held = pa.ListArray.from_arrays(pa.array(bounds), pa.array(feature.astype(np.int32)))
                yield pa.record_batch([batch.column(1).slice(at, end - at).cast(pa.int32()), held], names=["grade", "features"])

    sample = rated_sample(documents, ratings, max_rated).mapInArrow(extract, "grade int, features array<int>")
    sample = stored(sample.coalesce(PARTS), "rated-features")
    total = sample.count()
    if not total:
        return OrdinalModel(np.zeros(SIZE, np.float32), np.full(top, -30.0))
    frequent = sample.select(F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_TEXTS)
    useful = np.sort(np.array([r["f"] for r in frequent.select("f").collect()], np.int64))  # at most SIZE numbers

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            feature = lists.flatten().to_numpy()
            keep = np.isin(feature, useful)
            bounds = np.searchsorted(row[keep], np.arange(batch.num_rows + 1)).astype(np.int32)
            held = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.searchsorted(useful, feature[keep]).astype(np.int32)))
            yield pa.record_batch([batch.column(0), held], names=["grade", "features"])

    sample = stored(sample.mapInArrow(renumber, "grade int, features array<int>"), "useful-features")
    size = len(useful)

    def partial(current: OrdinalModel):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slope = np.zeros(size + top)
            for batch in batches:
                lists = batch.column(1)
                row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                slope += np.concatenate(gradient(current, batch.column(0).to_numpy(), row, lists.flatten().to_numpy()))
            yield pa.record_batch([pa.array([slope.tobytes()])], names=["slope"])

        return run

    parameters = np.concatenate([np.zeros(size), np.linspace(-1, 1, top) if top > 1 else np.zeros(1)])
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, steps + 1):
        current = OrdinalModel(parameters[:size].astype(np.float32), np.sort(parameters[size:]))
        # One row for each of the sample's few parts.
        parts = sample.mapInArrow(partial(current), "slope binary").collect()
        slope = sum(np.frombuffer(part["slope"]) for part in parts) / total
        slope[:size] += SHRINK * parameters[:size]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        parameters -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(SIZE, np.float32)
    weights[useful] = parameters[:size]
    return OrdinalModel(weights, np.sort(parameters[size:]))


def grade_documents(documents: DataFrame, model: OrdinalModel, tail: int, least: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, tail_probability = P(grade >= tail), and keep: the tail has ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in slices(batch.column(1)):
                above = model.above(model.score(data, offsets))
                chance = above[:, tail - 1]
                columns = [batch.column(0).slice(at, end - at), *map(pa.array, (above.sum(axis=1), chance, chance >= least))]
                yield pa.record_batch(columns, names=["doc_id", "expected_grade", "tail_probability", "keep"])

    schema = "doc_id long, expected_grade double, tail_probability double, keep boolean"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def keep_documents(documents: DataFrame, model: OrdinalModel, tail: int, least: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose text is selected."""
    text_at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.above(model.score(data, offsets))[:, tail - 1] >= least for _, _, data, offsets in slices(batch.column(text_at))]
            yield batch.filter(pa.array(np.concatenate(keep))) if keep else batch

    return documents.mapInArrow(run, documents.schema)


TOP_GRADE = 2


def grade_of_labels(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 poor, 2 good; null without a quality label."""
    return F.when(quality.isNull(), None).when(F.coalesce(toxic, F.lit(0)) != 0, 0).when(quality == 0, 1).otherwise(2)


def fit_to_labels(documents: DataFrame, labels: DataFrame, max_rated: int = MAX_RATED) -> OrdinalModel:
    ratings = labels.select("doc_id", grade_of_labels(F.col("quality"), F.col("toxic")).alias("grade"))
    return fit(documents, ratings, TOP_GRADE, max_rated)
