from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from hearthline.llm import jaccard_join as J
from hearthline.llm import words as W
from hearthline.llm.common import components, table

WHITE = " \t\n\v\f\r"


def word_list(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in WHITE else c for c in text or "")
    return [w for w in lowered.split(" ") if w]


def shingle_set(text, size):
    w = word_list(text)
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute_force(docs, size, percent):
    """(n, smallest id reachable) for each row, all pairs compared."""
    sets = [shingle_set(text, size) for _, text in docs]
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common * 100 >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for k in range(len(docs)):
        if docs[k][0] is not None:
            least[find(k)].append(docs[k][0])
    return [(docs[k][0], len(sets[k]), min(least[find(k)], default=None)) for k in range(len(docs))]


def got(spark, docs, size, percent):
    frame = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, name string, node long")
    rows = J.similar_components(frame, size=size, percent=percent).collect()
    return sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)


def test_whole_table(spark, small):
    docs = table(spark, small, "documents")
    rows = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.shingle_components(docs).collect()]
    assert sorted(rows) == sorted(brute_force([(r["doc_id"], r["text"]) for r in docs.collect()], 3, 90))


def edited(base, random, changes):
    w = base.split()
    for _ in range(changes):
        w[random.randrange(len(w))] = f"new{random.randrange(10**9)}"
    return " ".join(w)


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_groups_of_near_copies(spark, size, percent):
    """A large group around one text, chains at the threshold, and a passage that most texts share."""
    rng = random.Random(size)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    make = lambda n: " ".join(rng.choices(vocabulary, k=n))
    base = make(120)
    texts = [edited(base, rng, rng.choice([0, 1, 1, 2, 3])) for _ in range(60)]
    chain = make(150)
    for _ in range(12):
        chain = edited(chain, rng, rng.choice([1, 2, 3]))
        texts.append(chain)
    texts += [f"{make(25)} {passage} {make(25)}" for _ in range(40)]
    texts += [make(rng.choice([1, 2, 3, 4, 9, 10, 11, 30])) for _ in range(40)]
    texts += [passage] * 20 + [passage.upper().replace(" ", "\n")] * 3
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    assert got(spark, docs, size, percent) == sorted(brute_force(docs, size, percent), key=str)


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE "), (6, "one two"), (None, "one two"), (None, "alone here"), (8, "a b c"), (8, "a b c"), (8, "x y z"), (9, "x  y\nz")]
    docs += [(20, "long " * 20_000 + "end"), (21, "long " * 30_000 + "end")]
    assert got(spark, docs, 3, 90) == sorted(brute_force(docs, 3, 90), key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert J.similar_components(empty).collect() == []
    assert J.keep_one(empty).collect() == []


def test_keep_one(spark):
    rows = [(3, "a b c d e f", "x"), (1, "A b c d e f", "y"), (2, "other words stand in here", "z"), (4, None, "n"), (5, "", "n")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = J.keep_one(frame)
    assert kept.schema.names == frame.schema.names
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 5]


def kept_of(rows, size=5, percent=80):
    """Rows without words, and of each component the least (id, hash) once, from all pairs."""
    sets = [shingle_set(text, size) for _, text, _ in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common * 100 >= percent * (len(sets[i]) + len(sets[j]) - common):
                root = [root[j] if r == root[i] else r for r in root]
    out = [(id, text) for (id, text, _), s in zip(rows, sets, strict=True) if not s]
    for r in {r for r, s in zip(root, sets, strict=True) if s}:
        out.append(min(((id, text) for k, (id, text, hash) in enumerate(rows) if root[k] == r), key=lambda d: (d[0] is None, d[0] or 0, hash_of(rows, d))))
    return sorted(out, key=str)


def hash_of(rows, doc):
    return next(hash for id, text, hash in rows if (id, text) == doc)


def test_keep_one_with_null_shared_and_repeated_ids(spark):
    first, second, third, alone = (" ".join(f"{p}{k}" for k in range(40)) for p in "abcd")
    near = first + " more"
    rows = [(5, first), (7, first), (7, second), (7, second), (7, None), (7, "")]
    rows += [(None, near), (None, alone), (None, ""), (None, None), (None, third), (None, third), (None, third + " x"), (None, third.upper())]
    rows += [(9, alone + " z"), (9, "short text"), (9, "short text"), (9, "other one"), (9, "other  one"), (8, "other one")]
    rows += [(20, "twice seen by one id"), (20, "Twice seen by one id"), (None, "twice seen by one id")]
    frame = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _text_hash int")
    hashed = [tuple(r) for r in frame.selectExpr("doc_id", "text", "xxhash64(coalesce(text, ''))").collect()]
    for parts in (1, 5):
        kept = J.keep_one(frame.repartition(parts))
        assert kept.schema == frame.schema
        assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == kept_of(hashed)


def test_prefix_of_any_order_is_shared():
    rng = np.random.default_rng(3)
    classes = rng.integers(0, 255, (J.ORDERS, 1 << 10)).astype(np.uint8)
    for _ in range(200):
        n = int(rng.integers(1, 80))
        common = rng.integers(0, 1 << 63, n).astype(np.uint64)
        more = rng.integers(0, 1 << 63, int(rng.integers(0, 8))).astype(np.uint64)
        a, b = np.unique(common), np.unique(np.concatenate([common[: max(1, n - 4)], more]))
        meet = len(np.intersect1d(a, b))
        if meet * 100 >= 90 * (len(a) + len(b) - meet):
            for x, y in zip(J._prefixes(a, classes, 90), J._prefixes(b, classes, 90), strict=True):
                assert np.intersect1d(x, y).size


def test_words_match_plain_python():
    texts = ["A b\tC  d", "", None, "é É x y", "one", "\x0b\x0c a", "long" * 1000 + " b"]
    data, bounds = W.text_bytes(pa.array(texts))
    words = W.find_words(data, bounds, W.PLAIN)
    assert words.counts.tolist() == [len(word_list(t)) for t in texts]
    hashes, names = words.hashes().tolist(), [w for t in texts for w in word_list(t)]
    assert len({*zip(hashes, names, strict=True)}) == len({*hashes}) == len({*names})


def test_components_of_paths(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7)] + [(1000, 1001 + k) for k in range(50)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys((90, 95, 100), 90), **dict.fromkeys(range(1000, 1051), 1000)}
