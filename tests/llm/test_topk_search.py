from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.llm import topk_search as K


def usable(vec_id, vector):
    return vec_id is not None and bool(vector) and all(x is not None and math.isfinite(x) and abs(x) < 1e5 for x in vector)


def brute_force(rows, every, k=5):
    held = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if usable(i, v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in held if i % every == 0}:
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in held if i != q and len(b) == len(a))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def check(spark, rows, every=5, k=5):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, rank string").repartition(4)
    got = sorted(tuple(r) for r in K.top_products(frame, F.col("vec_id") % every == 0, k).collect())
    assert got == brute_force(rows, every, k)
    return got


@pytest.fixture
def small_pages(monkeypatch):
    """Many shards, pages and blocks from few rows."""
    for name, value in {"SHARD": 40, "LEAF": 6, "FANOUT": 3, "BLOCK": 7, "WALK": 5}.items():
        monkeypatch.setattr(K, name, value)


def random_rows(seed, n, dimension, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dimension)) * rng.uniform(0.1, 2, (8, 1))
    return [(k, (centres[rng.integers(8)] + spread * rng.normal(size=dimension)).tolist()) for k in range(n)]


@pytest.mark.parametrize("spread", [0.001, 0.3, 3.0])
def test_trees_of_many_pages_against_brute_force(spark, small_pages, spread):
    check(spark, random_rows(int(spread * 10), 300, 6, spread))


def test_copies_and_ties(spark, small_pages):
    one, other = [1.0, 0.5], [0.5, 1.0]
    rows = [(k, one) for k in range(60)] + [(100 + k, other) for k in range(60)] + [(200 + k, [0.5, 0.996]) for k in range(9)]
    rows += [(5, one), (5, one), (7, one), (300, [-1.0, -1.0]), (305, [0.0, 0.0])]
    check(spark, rows)


def test_awkward_vectors(spark):
    one = [1.0, -2.0, 0.001]
    rows = [(0, one), (5, None), (10, []), (15, [1.0, None, 2.0]), (20, [float("nan"), 1.0, 1.0]), (25, [float("-inf"), 1.0, 1.0])]
    rows += [(None, one), (30, [1.0, 2.0]), (35, [3.0, 4.0]), (40, [7.0]), (1, [0.0, 0.0, 0.0]), (-5, [-0.001, 0.003, 9.0]), (45, [1e300, 0.0, 0.0])]
    got = check(spark, rows)
    assert {g[0] for g in got} == {0, 30, 35, -5} and 40 not in {g[2] for g in got}
    check(spark, [])
    check(spark, [(5, one)])
    check(spark, [(1, one), (2, one)])


def test_walk_leaves_pages_out():
    """In clustered vectors most pages are passed over."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16)) * 100
    vectors = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(size=(6000, 16)))
    tree = K._Tree(vectors)
    pages = {}
    for number, leaf, entries, parent, radius, norm, child in tree.pages:
        ids = np.repeat(np.asarray(entries)[:, None], 6, axis=1)
        row = {"leaf": leaf, "vectors": vectors[entries].astype(np.int32).tobytes(), "child": np.asarray(child, np.int32).tobytes()}
        row |= {c: np.asarray(x, float).tobytes() for c, x in (("parent", parent), ("radius", radius), ("norm", norm))}
        row |= {"ids": ids.astype(np.int64).tobytes(), "copies": np.eye(1, 6, dtype=np.int32).repeat(len(entries), 0).tobytes()}
        pages[number] = K._Page(row, 16, 5)

    class Counting(dict):
        seen = 0

        def __getitem__(self, key):
            Counting.seen += 1
            return super().__getitem__(key)

    for q in range(0, 6000, 200):
        got = K._walk(Counting(pages), vectors[q], q, 5, -math.inf)
        scores = vectors @ vectors[q]
        scores[q] = -math.inf
        want = sorted((-s, i) for i, s in enumerate(scores.tolist()))[:5]
        assert got == want
    assert Counting.seen < 0.5 * 30 * len(pages)


def test_queries_walk_a_tree_together():
    """Each page is fetched once for all queries, and each query gets what it gets alone."""
    rng = np.random.default_rng(6)
    vectors = np.floor(rng.normal(size=(3000, 8)) * rng.uniform(1, 200, (3000, 1)))
    pages = {}
    for number, leaf, entries, parent, radius, norm, child in K._Tree(vectors).pages:
        ids = np.repeat(np.asarray(entries)[:, None], 6, axis=1)
        row = {"leaf": leaf, "vectors": vectors[entries].astype(np.int32).tobytes(), "child": np.asarray(child, np.int32).tobytes()}
        row |= {c: np.asarray(x, float).tobytes() for c, x in (("parent", parent), ("radius", radius), ("norm", norm))}
        row |= {"ids": ids.astype(np.int64).tobytes(), "copies": np.eye(1, 6, dtype=np.int32).repeat(len(entries), 0).tobytes()}
        pages[number] = K._Page(row, 8, 5)

    class Counting(dict):
        seen = 0

        def __getitem__(self, key):
            Counting.seen += 1
            return super().__getitem__(key)

    scores = vectors[:200] @ vectors.T
    scores[np.arange(200), np.arange(200)] = -math.inf
    # Some know a floor that they just reach, one a floor beyond all.
    floors = np.where(np.arange(200) % 3 == 0, np.sort(scores, axis=1)[:, -5], -math.inf)
    floors[7] = scores[7].max() + 1
    got = K._walk_all(Counting(pages), vectors[:200], list(range(200)), 5, floors)
    assert Counting.seen <= len(pages)
    want = [sorted((-s, i) for i, s in enumerate(row.tolist()))[:5] for row in scores]
    assert [g for q, g in enumerate(got) if q != 7] == [w for q, w in enumerate(want) if q != 7] and got[7] == []
