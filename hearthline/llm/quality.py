"""Quality of texts: random-indexing word vectors and a small neural network.

Every token has a fixed sparse random index vector. A token's word vector is
the sum of the index vectors of its neighbours, over all texts. A document is
the mean of its words' vectors and of the vectors of its words' shapes (case,
punctuation, length, repeat), and a two-layer network turns that into a
probability, which one fitted temperature calibrates.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm import words as W
from hearthline.llm.common import array_rows, batches, cut, sum_arrays

#: Rows of the vector table: words and shapes share them by hash.
WORD_BITS, SHAPE_BITS = 15, 10
DIMENSIONS, NONZERO = 32, 4
#: Labelled documents that the network is fitted on, at most.
MAX_TRAINING = 20_000
HIDDEN, EPOCHS, RATE, PENALTY = 32, 60, 0.004, 1e-4
THRESHOLD = 0.3
_ROWS = (1 << WORD_BITS) + (1 << SHAPE_BITS)
#: Word pairs counted at once.
_COUNTED = 1 << 18

_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(97, 123)]] = 1  # small letters
_CLASS[[*range(65, 91)]] = 2  # capitals
_CLASS[[*range(48, 58)]] = 4  # digits
_CLASS[[*range(128, 256)]] = 8  # not ASCII
_CLASS[[b for b in range(33, 127) if not _CLASS[b]]] = 16  # punctuation


def _tokens(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Row of the vector table of each word, and of its shape."""
    hashes = words.hashes()
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    kinds = np.bitwise_or.reduceat(_CLASS[words.data], _interleave(words))[::2]
    length = words.ends - words.starts
    first, last = words.data[words.starts], words.data[words.ends - 1]
    before_last = words.data[np.maximum(words.ends - 2, words.starts)]
    same = np.zeros(n, np.uint64)
    same[1:] = hashes[1:] == hashes[:-1]
    starts = words.first[:-1][words.counts > 0]
    same[starts] = 0
    # Punctuation at the end by its bytes, other endings by their class.
    end = np.where(_CLASS[last] == 16, last.astype(np.uint64), np.uint64(0))
    doubled = (last == before_last) & (length > 1) & (_CLASS[last] == 16)
    code = kinds.astype(np.uint64)
    for part in (_CLASS[first].astype(np.uint64), end, doubled.astype(np.uint64), np.minimum(np.log2(length).astype(np.uint64), np.uint64(6)), same):
        code = code * np.uint64(257) + part
    shape = (W.mix(code + np.uint64(5)) >> np.uint64(64 - SHAPE_BITS)).astype(np.int64) + (1 << WORD_BITS)
    return word, shape


def _interleave(words: W.Words) -> np.ndarray:
    """Starts and ends in turn, as ``reduceat`` takes them."""
    out = np.empty(2 * len(words.starts), np.int64)
    out[::2], out[1::2] = words.starts, words.ends
    return out[:-1] if out[-1] >= len(words.data) else out


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each row's index vector."""
    seeds = W.mix(np.arange(_ROWS, dtype=np.uint64)[:, None] * np.uint64(NONZERO) + np.arange(NONZERO, dtype=np.uint64) + np.uint64(17))
    return (seeds % np.uint64(DIMENSIONS)).astype(np.int64), 1 - 2 * (seeds >> np.uint64(63)).astype(np.int64)


def _context_task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    sums = np.zeros(_ROWS * DIMENSIONS)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def count() -> None:
        one = np.concatenate([a for a, _ in waiting])
        other = np.concatenate([b for _, b in waiting])
        waiting.clear()
        # Equal pairs first become one with a weight.
        pairs, times = np.unique(one * _ROWS + other, return_counts=True)
        one, other = pairs // _ROWS * DIMENSIONS, pairs % _ROWS
        for k in range(NONZERO):
            sums.__iadd__(np.bincount(one + places[other, k], signs[other, k] * times, minlength=len(sums)))

    held = 0
    for batch in stream:
        for _, data, bounds in W.pieces(batch.column(0)):
            words = W.find_words(data, bounds, W.PLAIN)
            texts = words.texts
            together = texts[1:] == texts[:-1]
            for tokens in _tokens(words):
                a, b = tokens[:-1][together], tokens[1:][together]
                waiting.append((np.concatenate([a, b]), np.concatenate([b, a])))
                held += 2 * len(a)
            if held >= _COUNTED:
                count()
                held = 0
    if held:
        count()
    yield array_rows(sums)


def word_vectors(texts: DataFrame) -> np.ndarray:
    """The vector table from all neighbours in all texts; its size is fixed.

    Sums are whole numbers, so they do not depend on the order of adding. Each
    vector is centred and has length one; rows of no token are zero.
    """
    sums = sum_arrays(texts.mapInArrow(_context_task, "slice int, data binary"), _ROWS * DIMENSIONS).reshape(_ROWS, DIMENSIONS).astype(float)
    out = np.zeros((_ROWS, DIMENSIONS), np.float32)
    for part in (slice(0, 1 << WORD_BITS), slice(1 << WORD_BITS, _ROWS)):
        lengths = np.linalg.norm(sums[part], axis=1, keepdims=True)
        unit = np.divide(sums[part], lengths, out=np.zeros_like(sums[part]), where=lengths > 0)
        seen = lengths[:, 0] > 0
        unit[seen] -= unit[seen].mean(axis=0) if seen.any() else 0
        lengths = np.linalg.norm(unit, axis=1, keepdims=True)
        out[part] = np.divide(unit, lengths, out=np.zeros_like(unit), where=lengths > 1e-9)
    return out


def _pool_batch(shared: Broadcast, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    vectors = shared.value
    for place, data, bounds in W.pieces(batch.column(1)):
        words = W.find_words(data, bounds, W.PLAIN)
        filled = words.counts > 0
        pooled = np.zeros((len(filled), 2 * DIMENSIONS), np.float32)
        if filled.any():
            for k, tokens in enumerate(_tokens(words)):
                sums = np.add.reduceat(vectors[tokens], words.first[:-1][filled], axis=0)
                pooled[filled, k * DIMENSIONS : (k + 1) * DIMENSIONS] = sums / words.counts[filled, None]
        arrays = [batch.column(0)[place], pa.array(list(pooled), pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "pooled"])


@dataclass
class Network:
    """Standardisation, two layers, and a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((pooled - self.mean) / self.scale @ w1 + b1) @ w2 + b2[0]

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled) / self.temperature, -40, 40)))


def train(pooled: np.ndarray, labels: np.ndarray, calibrate: np.ndarray, seed: int = 7) -> Network:
    """A network fitted by Adam on the rows not in ``calibrate``, with the
    temperature that makes those rows likeliest."""
    random = np.random.default_rng(seed)
    x, y = pooled[~calibrate].astype(float), labels[~calibrate].astype(float)
    if not len(x):
        x, y = np.zeros((1, pooled.shape[1])), np.ones(1)
    network = Network(x.mean(axis=0), x.std(axis=0) + 1e-3, [])
    x = (x - network.mean) / network.scale
    width = x.shape[1]
    layers = [random.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    means, squares = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    size, step = 128, 0
    # Small training sets get more passes, so that all see enough steps.
    for _ in range(max(EPOCHS, -(-2000 * size // len(x)) if len(x) < 2000 * size // EPOCHS else 0)):
        order = random.permutation(len(x))
        for low in range(0, len(x), size):
            part = order[low : low + size]
            w1, b1, w2, b2 = layers
            hidden = np.tanh(x[part] @ w1 + b1)
            error = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2[0], -40, 40))) - y[part]) / len(part)
            back = np.outer(error, w2) * (1 - hidden**2)
            gradients = [x[part].T @ back + PENALTY * w1, back.sum(axis=0), hidden.T @ error + PENALTY * w2, np.array([error.sum()])]
            step += 1
            for p, g, m, s in zip(layers, gradients, means, squares, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g**2 - s)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    network.layers = layers
    if calibrate.any():
        logits, sign = network.logits(pooled[calibrate]), 2 * labels[calibrate] - 1
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 71))
        network.temperature = float(grid[np.argmin([np.logaddexp(0, -sign * logits / t).mean() for t in grid])])
    return network


def held_out(id: str):
    return F.crc32(F.col(id).cast("string")) % 5 == 0


def score(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted), a row a document.

    Word vectors come from all texts. Labels (0 or 1; other rows are left out)
    are learnt from ids whose crc32 is not divisible by 5, up to MAX_TRAINING
    rows, those with the least hash of their id, equal rows of an id once; a
    sixth of them sets the temperature. The score sees the text alone, so a null or empty text or one
    without words has the score of a document of zero vectors, and repeated
    rows are alike. Rows with a null id are scored, but not learnt from.
    """
    docs = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    vectors = docs.sparkSession.sparkContext.broadcast(word_vectors(docs.select("text")))
    pooled = docs.mapInArrow(batches(functools.partial(_pool_batch, vectors)), f"id {kind}, pooled array<float>")
    # Texts are pooled once, for fitting and for scoring.
    pooled = cut(pooled, "pooled")
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(id)).select(F.col(id).alias("label_id"), F.col(label).cast("int").alias("label")).distinct()
    known = known.orderBy(F.xxhash64("label_id"), "label_id", "label").limit(MAX_TRAINING)
    rows = pooled.join(F.broadcast(known), pooled["id"] == known["label_id"]).select("label", "pooled", F.xxhash64("label_id").alias("hash"))
    # An id may stand for any number of rows; equal ones teach once, and the bound is on rows.
    rows = rows.distinct().orderBy("hash", "label", "pooled").limit(MAX_TRAINING).collect()
    x = np.array([r["pooled"] for r in rows], np.float32).reshape(len(rows), 2 * DIMENSIONS)
    network = train(x, np.array([r["label"] for r in rows], int), np.array([r["hash"] % 6 == 0 for r in rows], bool))

    def apply(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, 2 * DIMENSIONS)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(network.probability(values), pa.float64())], names=["id", "score"])

    out = pooled.mapInArrow(batches(apply), f"id {kind}, score double")
    return out.select("id", F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs.select("doc_id", "text"), labels).withColumnRenamed("id", "doc_id")
