from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.llm import resampling as R
from hearthline.llm.common import table


def words_of(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)


def buckets_of(text):
    words = words_of(text)
    grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return Counter(zlib.crc32(g.encode()) % 10000 for g in grams)


def brute_force(docs, target):
    """(id, n_features, weight, score, rank) of every row."""
    counted = [buckets_of(text) for _, text in docs]
    source, wanted = sum(counted, Counter()), sum((buckets_of(t) for t in target), Counter())
    big, small = sum(source.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (big + 10000) / ((source[b] + 1) * (small + 10000)))) for b in source}
    rows = []
    for (doc, text), counts in zip(docs, counted, strict=True):
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * n for b, n in counts.items())
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, sum(counts.values()), weight, score, len(words_of(text)) >= 20])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = 5 * len(able) // 100
    ranks = {id(r): k + 1 for k, r in enumerate(able[:drawn])}
    return [(*r[:4], ranks.get(id(r))) for r in rows]


def check(spark, docs, target):
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, weight string, rank int").repartition(5)
    wanted = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = [tuple(r) for r in R.importance_ranks(frame, wanted).collect()]
    assert sorted(got, key=str) == sorted(brute_force(docs, target), key=str)
    return got


def test_query_against_brute_force(spark, small):
    docs, bench = table(spark, small, "documents"), table(spark, small, "benchmark")
    got = sorted(tuple(r) for r in R.importance_ranks(docs, bench).collect())
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got == sorted(brute_force(pairs, [r["text"] for r in bench.collect()]))
    assert sum(r[4] is not None for r in got) >= 1


def test_awkward_rows(spark):
    long = "one Two three\tfour-five É中文 " * 20
    docs = [(1, None), (2, ""), (3, " .-_ "), (4, "A"), (5, "a B"), (None, long), (None, "w " * 40), (7, long), (7, long), (8, "\x00\x7fx\x80y 9")]
    docs += [(100 + k, f"{long} {k}") for k in range(90)] + [(500, "many words here " * 60_000)]
    got = check(spark, docs, [long, None, ""])
    assert sorted(r[4] for r in got if r[4]) == [1, 2, 3, 4]


def test_empty_tables(spark):
    check(spark, [], ["a b"])
    check(spark, [(1, "a b " * 30)] * 20, [])


def test_spans_equal_plain_runs():
    rng = np.random.default_rng(5)
    for _ in range(200):
        text = "".join(rng.choice(list("aB1 -é\n_"), rng.integers(0, 30)))
        words = words_of(text)
        plain = Counter(" ".join(words[i : i + n]).encode() for n in (1, 2, 3) for i in range(len(words) - n + 1))
        assert Counter(R.features(R.spaced(text))) == plain


@pytest.mark.parametrize("size", [0, 1, 1000])
def test_ranks_are_gapless_with_ties(spark, size):
    rows = spark.range(size).select((F.col("id") % 3).alias("score"), (F.col("id") % 7 != 0).alias("able"))
    got = R.ranked(rows.repartition(6), [F.desc("score")], F.col("able"), "place").collect()
    placed = sorted((r["place"], r["score"]) for r in got if r["able"])
    assert [p for p, _ in placed] == list(range(1, len(placed) + 1))
    assert [s for _, s in placed] == sorted((s for _, s in placed), reverse=True)
    assert all(r["place"] is None for r in got if not r["able"]) and len(got) == size
