from __future__ import annotations

import functools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.llm import quality, toxicity
from hearthline.llm import words as W
from hearthline.llm.common import batches, table

# Held-out accuracy needs more labels than the smallest tables have.
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    scores = quality.quality_scores(docs, labels)
    assert scores.count() == docs.count()
    rows = scores.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)


def test_quality_learns_nothing_from_held_out_labels(tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = ({r["doc_id"]: r["score"] for r in quality.quality_scores(docs, part).collect()} for part in (labels, turned))
    assert one == other


def test_quality_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (None, "no id", 5.0), (3, "same", 5.0), (3, "same", 5.0), (4, "long word " * 50_000, 5.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 1), (None, 1), (2, None)], "doc_id long, quality int")
    rows = quality.score(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["id"] in (1, 2)}) == 1
    assert quality.score(docs.where("false"), labels).collect() == []
    assert len(quality.score(docs, labels.where("false")).collect()) == 6


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4)).astype(np.float32)
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    held = np.arange(3000) % 6 == 0
    network = quality.train(x, y, held)
    p = network.probability(x[held])
    assert abs(p.mean() - y[held].mean()) < 0.06
    assert -np.log(np.where(y[held] == 1, p, 1 - p)).mean() < 0.55


def test_word_vectors_do_not_depend_on_partitions(spark, small):
    texts = table(spark, small, "documents").select("text")
    assert np.array_equal(quality.word_vectors(texts), quality.word_vectors(texts.repartition(5)))


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, labels.where(~held))
    rows = toxicity.score(docs, model).join(labels.where(held), F.col("id") == F.col("doc_id")).collect()
    assert np.mean([r["rejected"] == (r["toxic"] == 1) for r in rows]) > 0.94
    assert not any(r["rejected"] for r in rows if r["toxic"] == 0)
    assert all(0 <= r["severity"] <= toxicity.GRADES and r["grade"] >= r["rejected"] for r in rows)


def test_toxic_rows_go_and_clean_ones_stay(tables):
    docs, labels = tables
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.schema.names == docs.schema.names
    rejected = {r["doc_id"] for r in toxicity.graded(docs, labels).where("rejected").collect()}
    assert sorted(kept.toPandas()["doc_id"]) == sorted(set(docs.toPandas()["doc_id"]) - rejected)
    assert rejected


def test_toxicity_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "bad bad", "x"), (3, "vile words", "x"), (4, "vile words", "x"), (5, "vile " * 50_000, "x"), (6, "plain talk", "x")], "doc_id long, text string, grade string")
    labels = spark.createDataFrame([(3, 1), (4, 1), (6, 0), (2, 0), (None, 1), (1, None)], "doc_id long, toxic int")
    for known in (labels, labels.where("toxic = 0"), labels.where("false")):
        rows = toxicity.score(docs, toxicity.fit(docs, known)).collect()
        assert len(rows) == 7 and all(0 <= r["probability"] <= 1 for r in rows)
        assert toxicity.drop_toxic(docs, known).schema.names == docs.schema.names
    assert toxicity.drop_toxic(docs.where("false"), labels).collect() == []


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(2)
    grades = rng.integers(0, 4, 2000)
    hits = [rng.random(3) < g / 4 for g in grades]
    rows = np.concatenate([np.full(h.sum(), k) for k, h in enumerate(hits)])
    columns = np.concatenate([np.flatnonzero(h) for h in hits])
    weights, thresholds = toxicity.fit_ordinal(rows, columns, grades, 3)
    assert (weights > 0).all() and (np.diff(thresholds) > 0).all()
    model = toxicity.Model(np.arange(3, dtype=np.uint64), weights, thresholds)
    severity = model.at_least(np.bincount(rows, weights[columns], minlength=2000)).sum(axis=1)
    means = [severity[grades == g].mean() for g in range(4)]
    assert means == sorted(means)


# --- brute force: the same numbers by loops over words ---------------------------


def token_rows(text):
    """The vector table's rows of a text's words and shapes."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    return [list(rows) for rows in quality._tokens(W.find_words(data, np.array([0, len(data)]), W.PLAIN))]


def plain_vectors(texts):
    places, signs = quality.index_vectors()
    size = (1 << quality.WORD_BITS) + (1 << quality.SHAPE_BITS)
    sums = np.zeros((size, quality.DIMENSIONS))
    for text in texts:
        for rows in token_rows(text):
            for k, row in enumerate(rows):
                for near in rows[max(0, k - 1) : k] + rows[k + 1 : k + 2]:
                    for place, sign in zip(places[near], signs[near], strict=True):
                        sums[row, place] += sign
    out = np.zeros_like(sums)
    for part in (range(1 << quality.WORD_BITS), range(1 << quality.WORD_BITS, size)):
        seen = [k for k in part if sums[k].any()]
        if seen:
            unit = sums[seen] / np.linalg.norm(sums[seen], axis=1, keepdims=True)
            unit -= unit.mean(axis=0)
            lengths = np.linalg.norm(unit, axis=1, keepdims=True)
            out[seen] = np.where(lengths > 1e-9, unit / np.maximum(lengths, 1e-9), 0)
    return out


def plain_pooled(vectors, text):
    kinds = [vectors[rows].mean(axis=0) if rows else np.zeros(quality.DIMENSIONS) for rows in token_rows(text)]
    return np.concatenate(kinds)


TEXTS = ["A clean line, with words.", "clean words with a line", "BUY!!! buy!!! now 100%", "buy now!!! é", "", None, "one", "with with with with", "words of a clean text. A line."]


def test_vectors_and_pooling_by_brute_force(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    vectors = quality.word_vectors(frame.select("text"))
    want = plain_vectors(TEXTS)
    assert np.allclose(vectors, want, atol=1e-6) and (np.abs(want).sum(axis=1) > 0).sum() > 20
    rows = frame.mapInArrow(batches(functools.partial(quality._pool_batch, spark.sparkContext.broadcast(vectors))), "id long, pooled array<float>").collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert np.allclose(r["pooled"], plain_pooled(want, TEXTS[r["id"]]), atol=1e-5)


def test_forward_pass_by_brute_force():
    random = np.random.default_rng(3)
    layers = [random.normal(size=(4, 3)), random.normal(size=3), random.normal(size=3), np.array([0.3])]
    network = quality.Network(random.normal(size=4), random.uniform(0.5, 2, 4), layers, temperature=1.7)
    for x in random.normal(size=(20, 4)):
        z = [(x[i] - network.mean[i]) / network.scale[i] for i in range(4)]
        hidden = [math.tanh(sum(z[i] * layers[0][i, j] for i in range(4)) + layers[1][j]) for j in range(3)]
        logit = sum(hidden[j] * layers[2][j] for j in range(3)) + 0.3
        assert abs(network.probability(x[None])[0] - 1 / (1 + math.exp(-logit / 1.7))) < 1e-12


def test_scores_by_brute_force(spark):
    """The whole chain: vectors, pooling, the rows that teach, the forward pass."""
    docs = [(k, f"{TEXTS[k % 3]} {'good' if k % 2 else 'bad'} {k % 7}") for k in range(60)] + [(3, f"{TEXTS[0]} good 3")] * 40
    labels = [(k, k % 2) for k in range(60)]
    got = quality.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    vectors = plain_vectors([t for _, t in docs])
    # Repeated rows teach once.
    taught = [(k, t) for k, t in sorted(set(docs)) if zlib.crc32(str(k).encode()) % 5]
    hashes = {r["id"]: r["hash"] for r in spark.range(60).select("id", F.xxhash64("id").alias("hash")).collect()}
    taught.sort(key=lambda d: hashes[d[0]])
    pooled = np.array([plain_pooled(vectors, t) for _, t in taught], np.float32)
    network = quality.train(pooled, np.array([k % 2 for k, _ in taught]), np.array([hashes[k] % 6 == 0 for k, _ in taught]))
    want = {k: float(network.probability(plain_pooled(vectors, t)[None])[0]) for k, t in docs}
    assert len(got) == len(docs)
    # Training amplifies the last digits of single precision.
    assert max(abs(r["score"] - want[r["id"]]) for r in got) < 0.02
    assert all(r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


def test_rows_of_one_labelled_id_are_bounded(spark, monkeypatch):
    """One labelled id with more texts than may be learnt from."""
    monkeypatch.setattr(quality, "MAX_TRAINING", 50)
    taken = []
    train = quality.train
    monkeypatch.setattr(quality, "train", lambda x, y, c: taken.append(len(x)) or train(x, y, c))
    docs = spark.range(400).selectExpr("3L as doc_id", "concat_ws(' ', transform(sequence(0, id % 37 + id div 37), k -> 'w' || k * id % 91)) as text")
    labels = spark.createDataFrame([(3, 1)], "doc_id long, quality int")
    assert quality.score(docs, labels).count() == 400
    assert taken == [50]


def loss(values, examples, grades, top, penalty):
    """Penalised mean negative log-likelihood of a cumulative-link model, by loops."""
    *weights, first = values[: -(top - 1)] if top > 1 else values
    thresholds = [first]
    for step in values[len(values) - (top - 1) :]:
        thresholds.append(thresholds[-1] + math.exp(step))
    total = 0.0
    for marks, grade in zip(examples, grades, strict=True):
        own = sum(weights[k] for k in marks)
        reach = [1.0, *(1 / (1 + math.exp(t - own)) for t in thresholds), 0.0]
        total -= math.log(reach[grade] - reach[grade + 1])
    return total / len(examples) + penalty / 2 * sum(w * w for w in weights)


def test_ordinal_fit_is_a_minimum_of_the_likelihood():
    random = np.random.default_rng(5)
    examples = [sorted(np.flatnonzero(random.random(5) < 0.4).tolist()) for _ in range(120)]
    truth = [2.0, 1.0, 0.0, -1.0, 0.5]
    grades = np.array([int(np.clip(round(sum(truth[k] for k in marks) + random.normal()), 0, 3)) for marks in examples])
    rows = np.repeat(np.arange(120), [len(m) for m in examples])
    columns = np.concatenate([np.array(m, np.int64) for m in examples])
    weights, thresholds = toxicity.fit_ordinal(rows, columns, grades, 5, penalty=0.02, steps=4000, rate=0.01)
    assert (np.diff(thresholds) > 0).all()
    values = [*weights, thresholds[0], *np.log(np.diff(thresholds))]
    for k in range(len(values)):
        up, down = (list(values), list(values))
        up[k] += 1e-4
        down[k] -= 1e-4
        slope = (loss(up, examples, grades, 3, 0.02) - loss(down, examples, grades, 3, 0.02)) / 2e-4
        assert abs(slope) < 2e-3, (k, slope)


def test_severity_by_brute_force(spark):
    """Link function and expected severity from the weights of a text's distinct features."""
    texts = ["vile words here", "vile vile", "", None, "calm words", "Vileness of words"]
    found = {}
    for text in texts:
        data = np.frombuffer((text or "").encode(), np.uint8)
        _, features = toxicity._features(W.find_words(data, np.array([0, len(data)]), W.ALPHANUMERIC))
        found[text] = set(features.tolist())
    some = np.array(sorted(found["vile words here"]), np.uint64)
    model = toxicity.Model(some, np.linspace(-1, 2, len(some)), np.array([0.5, 1.0, 3.0]))
    out = toxicity.score(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"), model).collect()
    assert len(out) == len(texts) and found["vile words here"] & found["Vileness of words"]
    for r in out:
        own = sum(w for f, w in zip(some.tolist(), model.weights.tolist(), strict=True) if f in found[texts[r["id"]]])
        reach = [1 / (1 + math.exp(t - own)) for t in (0.5, 1.0, 3.0)]
        assert abs(r["probability"] - reach[0]) < 1e-12 and abs(r["severity"] - sum(reach)) < 1e-12
        assert r["grade"] == sum(p >= 0.5 for p in reach) and r["rejected"] == (reach[0] >= 0.5)
