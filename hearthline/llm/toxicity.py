"""Toxicity by ordinal regression on sparse text features.

A text's features are its distinct words and word beginnings. A cumulative-link
model gives the probability that a text is at or above each severity grade:
one weight for each feature, shared by all grades, and a rising threshold for
each grade. The expected severity is the sum of these probabilities.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm import words as W
from hearthline.llm.common import batches, cut, free_name

#: Labelled texts that the model is fitted on, at most, of each label.
MAX_TOXIC, MAX_CLEAN = 4000, 8000
#: Features of the model, at most.
MAX_FEATURES = 4096
#: A feature is used if this many toxic training texts have it, and its rate
#: among them is so many times its rate among the others.
MIN_TEXTS, MIN_RATIO = 3, 8.0
#: Bytes of word beginnings.
BEGINNINGS = (4, 5)
GRADES = 3
THRESHOLD = 0.5
_FILTER_BITS = 20


def _features(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of all words and beginnings; repeats are not removed."""
    hashes = words.prefix_hashes(BEGINNINGS)
    lengths = words.ends - words.starts
    texts, owners, found = words.texts, [], []
    for kind, h in enumerate(hashes):
        longer = slice(None) if kind == 0 else lengths > BEGINNINGS[kind - 1]
        owners.append(texts[longer])
        found.append(W.mix(h[longer] + np.uint64(W.mix_int(500 + kind))))
    return np.concatenate(owners), np.concatenate(found)


def _signature(hashes: np.ndarray, turn: int) -> int:
    """Near copies mostly have the same four least hashes."""
    least = np.sort(np.unique(W.mix(hashes + np.uint64(W.mix_int(900 + turn)))))[:4]
    return int(np.bitwise_xor.reduce(W.mix(least * np.uint64(3))).view(np.int64)) if len(least) else 0


def _example_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for place, data, bounds in W.pieces(batch.column(1)):
        words = W.find_words(data, bounds, W.ALPHANUMERIC)
        owners, found = _features(words)
        order = np.argsort(owners, kind="stable")
        cuts = np.searchsorted(owners[order], np.arange(1, len(bounds) - 1))
        sets = [np.unique(part).view(np.int64) for part in np.split(found[order], cuts)]
        hashes = np.split(words.hashes(), words.first[1:-1])
        arrays = [
            batch.column(0)[place],
            pa.array(sets, pa.list_(pa.int64())),
            *(pa.array([_signature(h, turn) for h in hashes], pa.int64()) for turn in range(2)),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "features", "first", "second"])


@dataclass
class Model:
    """Sorted feature hashes with their weights, and the rising thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, sums: np.ndarray) -> np.ndarray:
        """For each sum of weights the probabilities of each grade or a higher one."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - sums[:, None], -40, 40)))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, n_features: int, penalty: float = 2e-4, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of a cumulative-link model, by full-batch Adam.

    ``rows`` and ``columns`` are the places of ones in the feature matrix. The
    thresholds are a first one and positive steps from each to the next, so
    they stay in order. P(grade >= k) is the logistic function of the sum of
    weights less threshold k; a grade's likelihood is the difference of two.
    """
    n, top = len(grades), int(grades.max(initial=1))
    values = np.concatenate([np.zeros(n_features), [1.0], np.zeros(top - 1)])
    mean, square = np.zeros_like(values), np.zeros_like(values)
    every = np.arange(n)
    for step in range(1, steps + 1):
        weights, first, gaps = values[:n_features], values[n_features], np.exp(values[n_features + 1 :])
        thresholds = first + np.concatenate([[0.0], np.cumsum(gaps)])
        sums = np.bincount(rows, weights[columns], minlength=n)
        above = 1 / (1 + np.exp(np.clip(thresholds[None, :] - sums[:, None], -40, 40)))
        slope = above * (1 - above)
        padded = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        slopes = np.concatenate([np.zeros((n, 1)), slope, np.zeros((n, 1))], axis=1)
        share = np.maximum(padded[every, grades] - padded[every, grades + 1], 1e-12)
        low, high = slopes[every, grades] / share, slopes[every, grades + 1] / share
        by_sum = -(low - high) / n
        by_threshold = np.zeros(top + 2)
        np.add.at(by_threshold, grades, low / n)
        np.add.at(by_threshold, grades + 1, -high / n)
        by_threshold = by_threshold[1:-1]
        gradient = np.empty_like(values)
        gradient[:n_features] = np.bincount(columns, by_sum[rows], minlength=n_features) + penalty * weights
        gradient[n_features] = by_threshold.sum()
        gradient[n_features + 1 :] = np.cumsum(by_threshold[::-1])[::-1][1:] * gaps
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        values = values - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    gaps = np.exp(values[n_features + 1 :])
    return values[:n_features], values[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])


def _mark_batch(features: np.ndarray, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Which of the model's features each example has."""
    marks = [np.flatnonzero(np.isin(features, np.array(own, np.int64).view(np.uint64))) for own in batch.column("features").to_pylist()]
    yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("toxic"), pa.array(marks, pa.list_(pa.int32()))], names=["row", "toxic", "marks"])


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from labelled texts (0 or 1; other rows are left out).

    Up to MAX_TOXIC and MAX_CLEAN labelled rows, those with the least hash of
    their id, take part; near copies among them count once. Labels only say
    toxic or not. The severity grade of a toxic text is 1 to GRADES by the
    number of distinct features in it that mark toxic texts, in equal parts;
    other texts have grade 0. Features are screened on Spark, and only rows of
    the few used come to the driver.
    """
    chosen = None
    for value, most in ((1, MAX_TOXIC), (0, MAX_CLEAN)):
        part = labels.where(F.col(label) == value).select(F.col(id).alias("label_id"), F.lit(value).alias("toxic")).where("label_id is not null").distinct()
        part = part.orderBy(F.xxhash64("label_id"), "label_id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    # At most MAX_TOXIC + MAX_CLEAN rows.
    texts = docs.join(F.broadcast(chosen), docs[id] == F.col("label_id")).select("toxic", F.col(text).cast("string").alias("text"))
    found = texts.mapInArrow(batches(_example_batch), "toxic int, features array<long>, first long, second long")
    found = cut(found.withColumn("row", F.monotonically_increasing_id()), "examples")
    for signature in ("first", "second"):
        found = found.join(found.groupBy(signature).agg(F.min("row").alias("row")).select("row"), "row")
    found = cut(found, "examples")
    totals = {r["toxic"]: r["count"] for r in found.groupBy("toxic").count().collect()}
    if not totals.get(1):
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES, 40.0))
    scale = (totals.get(0, 0) + 1) / totals[1]
    counts = found.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("hits"), F.sum(1 - F.col("toxic")).alias("others")
    )
    ratio = F.col("hits") * F.lit(scale) / (F.col("others") + 1)
    used = counts.where((F.col("hits") >= min(MIN_TEXTS, totals[1])) & (ratio >= MIN_RATIO))
    # Of many, those that most toxic texts have.
    used = used.orderBy(F.desc(F.col("hits") - F.col("others") * F.lit(1 / scale)), "feature").limit(MAX_FEATURES)
    features = np.sort(np.array([r["feature"] for r in used.select("feature").collect()], np.int64).view(np.uint64))
    marked = found.select("row", "toxic", "features").mapInArrow(batches(functools.partial(_mark_batch, features)), "row long, toxic int, marks array<int>")
    examples = marked.orderBy("row").collect()
    toxic = np.array([r["toxic"] for r in examples])
    sizes = np.array([len(r["marks"]) for r in examples])
    rows = np.repeat(np.arange(len(examples)), sizes)
    columns = np.array([k for r in examples for k in r["marks"]], np.int64)
    steps = np.quantile(sizes[toxic == 1], np.arange(1, GRADES) / GRADES)
    grades = np.where(toxic == 1, 1 + np.searchsorted(steps, sizes, "left"), 0)
    top = int(grades.max())
    weights, thresholds = fit_ordinal(rows, columns, grades, len(features))
    return Model(features, weights, np.concatenate([thresholds, np.full(GRADES - top, thresholds[-1] + 40.0)]))


def _score_batch(model: Model, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    shift = np.uint64(64 - _FILTER_BITS)
    maybe = np.zeros(1 << _FILTER_BITS, bool)
    maybe[(model.features >> shift).astype(np.int64)] = True
    for place, data, bounds in W.pieces(batch.column(1)):
        owners, found = _features(W.find_words(data, bounds, W.ALPHANUMERIC))
        near = maybe[(found >> shift).astype(np.int64)]
        owners, found = owners[near], found[near]
        columns = np.searchsorted(model.features, found).clip(0, max(0, len(model.features) - 1))
        hit = model.features[columns] == found if len(model.features) else np.zeros(0, bool)
        pairs = np.unique(owners[hit] * MAX_FEATURES + columns[hit])
        sums = np.bincount(pairs // MAX_FEATURES, model.weights[pairs % MAX_FEATURES] if len(pairs) else None, minlength=len(bounds) - 1)
        chances = model.at_least(sums)
        arrays = [batch.column(k)[place] for k in range(batch.num_columns) if k != 1]
        names = [batch.schema.names[k] for k in range(batch.num_columns) if k != 1]
        arrays += [pa.array(chances[:, 0], pa.float64()), pa.array(chances.sum(axis=1), pa.float64()), pa.array((chances >= 0.5).sum(axis=1), pa.int32())]
        yield pa.RecordBatch.from_arrays(arrays, names=[*names, "probability", "severity", "grade"])


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, text_hash, probability, severity, grade, rejected), a row a document.

    ``probability`` is that of grade 1 or more, ``severity`` the expected grade,
    ``grade`` the highest that is likelier than not. Null and empty texts have
    no features. Every row is scored by itself, so repeated rows are alike and
    null ids do not matter.
    """
    kind = docs.schema[id].dataType.simpleString()
    narrow = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"), F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text_hash"))
    out = narrow.mapInArrow(batches(functools.partial(_score_batch, model)), f"id {kind}, text_hash long, probability double, severity double, grade int")
    return out.withColumn("rejected", F.col("probability") >= threshold)


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return score(docs, fit(docs, labels)).select(F.col("id").alias("doc_id"), "probability", "severity", "grade", "rejected")


def drop_toxic(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text is toxic, in all its columns."""
    model = fit(docs, labels, id, text)
    hidden = free_name(docs.columns, "scored_text")
    flat = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(text).cast("string").alias(hidden))
    run = functools.partial(_filter_batch, model, threshold)
    out = flat.mapInArrow(batches(run), flat.select("row").schema)
    return out.select("row.*")


def _filter_batch(model: Model, threshold: float, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    chances = [c for scored in _score_batch(model, batch) for c in scored.column("probability").to_pylist()]
    kept = pa.array([c < threshold for c in chances])
    yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept)], names=["row"])
