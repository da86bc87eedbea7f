from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd

from hearthline.llm import embedding_dedup as E
from hearthline.llm import imatch
from hearthline.llm.common import table


def usable(vector, label):
    return vector is not None and label is not None and len(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def brute_force(rows, threshold=0.98):
    """(id, links, smallest id reachable) for each row, all pairs compared."""
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = [0] * len(rows)
    for i, (_, v, a) in enumerate(rows):
        for j in range(i):
            _, w, b = rows[j]
            if usable(v, a) and usable(w, b) and a == b and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, (id, _, _) in enumerate(rows):
        if id is not None:
            least[find(k)] = min(id, least.get(find(k), id))
    return [(rows[k][0], links[k], least.get(find(k))) for k in range(len(rows))]


def clusters(seed, sizes, spread):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        centre = rng.normal(size=16)
        rows += [(centre + rng.normal(size=16) * spread * np.linalg.norm(centre) / 4).tolist() for _ in range(size)]
    order = rng.permutation(len(rows))
    return [(int(k), rows[i], int(k) % 2 if len(sizes) > 10 else 1) for k, i in enumerate(order)]


def check(spark, rows, kind="double"):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], f"vec_id long, embedding array<{kind}>, label int, component_id string")
    out = E.vector_components(frame).collect()
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)
    return got, sorted(brute_force(rows), key=str)


def test_clusters_against_brute_force(spark):
    got, want = check(spark, clusters(1, [1] * 150 + [2] * 20 + [5] * 6 + [40], 0.02))
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert np.mean([g == w for g, w in zip(got, want, strict=True)]) > 0.98


def test_dense_cluster_is_counted_whole(spark):
    """More near vectors than a window or a block holds."""
    rows = clusters(2, [700], 0.001)
    got, want = check(spark, rows)
    assert got == want and want[0][1] == 699


def test_awkward_vectors(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(0, one, 1), (1, one, 1), (1, one, 1), (None, [2.0, 0.0, 0.0], 1), (3, one, None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 0.0], 1)]
    rows += [(7, [float("nan"), 1.0, 0.0], 1), (8, [float("inf"), 1.0, 0.0], 1), (9, [], 1), (10, [1.0, 0.0], 1), (11, [3.0, 0.0], 1), (12, [1e300, 0.0, 0.0], 1), (13, [1e-300, 0.0, 0.0], 1), (14, one, 2)]
    got, want = check(spark, rows)
    assert got == want
    assert E.vector_components(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_recall_on_the_table(spark):
    frame = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [tuple(r) for r in frame.select("vec_id", "embedding", "label").collect()]
    near = [(i + 10_000, [x + 1e-3 for x in v], label) for i, v, label in rows[::5]]
    got, want = check(spark, rows + near, "float")
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want)


def leaning(seed, rows, near, cosine, dimension=64):
    """Vectors whose cosines lie around ``cosine``, the first ``near`` with one more each at 0.982."""
    rng = np.random.default_rng(seed)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    vectors = unit(np.sqrt(cosine) * unit(rng.normal(size=(1, dimension))) + np.sqrt(1 - cosine) * unit(rng.normal(size=(rows, dimension))))
    aside = rng.normal(size=(near, dimension))
    aside = unit(aside - (aside * vectors[:near]).sum(axis=1, keepdims=True) * vectors[:near])
    return np.concatenate([vectors, 0.982 * vectors[:near] + np.sqrt(1 - 0.982**2) * aside])


def recall(spark, vectors):
    near = np.concatenate([(vectors[k : k + 1000] @ vectors.T >= 0.98).sum(axis=1) - 1 for k in range(0, len(vectors), 1000)])
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(vectors)), "embedding": vectors.tolist(), "label": 1}))
    links = {r["vec_id"]: r["n_links"] for r in E.vector_components(frame).collect()}
    assert all(links[k] <= n for k, n in enumerate(near.tolist()))
    return sum(links.values()) / near.sum()


def test_recall_where_vectors_lean_one_way(spark):
    assert recall(spark, leaning(4, 16_000, 4_000, 0.95)) >= 0.9


def test_label_compared_whole(spark, monkeypatch):
    """Where passes find nothing, all pairs are compared."""
    monkeypatch.setattr(E, "_window_stream", lambda threshold, window, stream: iter(()))
    monkeypatch.setattr(E, "WHOLE", 300)
    assert recall(spark, leaning(5, 700, 200, 0.5)) == 1


# --- fingerprints ---------------------------------------------------------------


def following(docs):
    """Each document with the next by descending id, null last, equal ids by text."""
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    return [(d, order[(k + 1) % len(order)]) for k, d in enumerate(order)]


def edited(text, other):
    n = len(text) // 3
    return text[: len(text) - n] + other[:n]


def expected(docs):
    out = []
    for (id, text), (_, other) in following(docs):
        whole = edited(text or "", other or "")
        out.append((id, len(text or ""), hashlib.sha256(whole.encode()).hexdigest()))
    return sorted(out, key=str)


def test_fingerprints_of_the_table(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, small, "documents").collect()]
    rows = imatch.document_fingerprints(table(spark, small, "documents")).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=str) == expected(docs)
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    by_text = {}
    for id, text in docs:
        assert by_text.setdefault(text, prints[id]) == prints[id]
    edit, next_ = (np.array([r[c] for r in rows]) for c in ("near_edited", "near_next"))
    assert ((0 <= edit) & (edit <= 1) & (0 <= next_) & (next_ <= 1)).all()
    # An edited text keeps two thirds of its own; the next one is another text.
    assert (edit > next_).mean() > 0.85 and edit.mean() > 5 * next_.mean()


def test_fingerprints_of_awkward_rows(spark):
    docs = [(1, None), (2, ""), (2, "tie"), (3, "a"), (None, "no id"), (None, None), (5, "é\U0001f600 " * 9), (6, "same words here"), (7, "same words here"), (8, "long words " * 50_000)]
    frame = spark.createDataFrame([(*d, "clash", 3) for d in docs], "doc_id long, text string, fingerprint string, range int")
    for parts in (1, 4):
        rows = imatch.document_fingerprints(frame.repartition(parts)).collect()
        assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=str) == expected(docs)
        same = {r["fingerprint"] for r in rows if r["doc_id"] in (6, 7)}
        assert len(same) == 1
    assert imatch.document_fingerprints(frame.where("false")).collect() == []
    alone = imatch.document_fingerprints(frame.where("doc_id = 3")).collect()
    assert [(r["near_next"], r["n_chars"]) for r in alone] == [(1.0, 1)]


def test_ranges_of_null_and_shared_ids(spark):
    """Many rows without an id, or of one id, are cut by text; a range sends one row."""
    docs = [(None, f"text {k * 7 % 400:03} of none") for k in range(400)] + [(50, f"é{k * 11 % 300:03} of one id") for k in range(300)]
    docs += [(k, f"own {k}") for k in range(100)] + [(None, "")] * 3 + [(50, None), (1 << 60, "far"), ((1 << 60) + 1, "far"), (-5, "last")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = imatch.document_fingerprints(frame.repartition(5)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=str) == expected(docs)
    placed = imatch.with_next(frame.selectExpr("doc_id as id", "coalesce(text, '') as text")).groupBy("range", "guest").count().collect()
    assert all(r["count"] == 1 for r in placed if r["guest"])
    assert max(r["count"] for r in placed) <= 150


def test_fingerprints_with_ids_of_text(spark):
    docs = [(f"doc-{k:04}é", f"own words {k}") for k in range(300)] + [("hot", f"text {k * 7 % 200:03} of one id") for k in range(200)]
    docs += [(None, f"none {k}") for k in range(200)] + [("", "empty id"), ("\U0001f600", None), ("\uffff", "below the last")]
    order = sorted((d for d in docs if d[0] is not None), key=lambda d: d[1] or "")
    order.sort(key=lambda d: d[0], reverse=True)
    order += sorted((d for d in docs if d[0] is None), key=lambda d: d[1])
    want = [(id, len(text or ""), hashlib.sha256(edited(text or "", order[(k + 1) % len(order)][1] or "").encode()).hexdigest()) for k, (id, text) in enumerate(order)]
    frame = spark.createDataFrame(docs, "doc_id string, text string")
    for rows in (frame.repartition(5), frame.where("doc_id is null")):
        got = imatch.document_fingerprints(rows)
        assert got.schema["doc_id"].dataType.simpleString() == "string"
        if rows.count() == len(docs):
            assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got.collect()), key=str) == sorted(want, key=str)
        else:
            assert got.count() == 200
    placed = imatch.with_next(frame.selectExpr("doc_id as id", "coalesce(text, '') as text")).groupBy("range", "guest").count().collect()
    assert all(r["count"] == 1 for r in placed if r["guest"]) and max(r["count"] for r in placed) <= 150
    assert imatch.document_fingerprints(frame.where("false")).collect() == []


def test_lexicon_is_the_band(spark):
    texts = [f"everywhere {'half' if k % 2 else ''} once{k}" for k in range(40)]
    terms = imatch.lexicon(spark.createDataFrame([(t,) for t in texts], "text string"), low=0.1, high=0.6)
    assert len(terms) == 1
