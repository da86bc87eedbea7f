from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from hearthline.llm import periodic_runs as P
from hearthline.llm.common import table


def runs_of(words, least=6, periods=4):
    """(start, length, period), every period and every stretch tried."""
    found = []
    n = len(words)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, periods * q):
                stretch = words[i : j + q]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeated(words, doc_id):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def digest(doc_id, text):
    words = repeated(re.findall(r"[^\x20\x09-\x0D]+", text or ""), doc_id)
    runs = runs_of(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, *(hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)))


def random_words(rng, size, letters):
    """Words with planted repeats of several periods, and copies of whole passages."""
    words = rng.integers(0, letters, size).tolist()
    for _ in range(int(rng.integers(0, 6))):
        at, q, times = int(rng.integers(0, size + 1)), int(rng.integers(1, 9)), int(rng.integers(2, 9))
        words[at:at] = (words[at : at + q] or [0]) * times + words[at : at + int(rng.integers(0, q))]
    if words and rng.random() < 0.5:
        a, b = sorted(rng.integers(0, len(words), 2).tolist())
        words[len(words) :] = words[a:b]
    return words


@pytest.mark.parametrize("letters", [1, 2, 3, 8, 200])
def test_runs_against_brute_force(letters):
    rng = np.random.default_rng(letters)
    for _ in range(60):
        texts = [random_words(rng, int(rng.integers(0, 60)), letters) for _ in range(int(rng.integers(1, 6)))]
        flat = np.array([w for t in texts for w in t], np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        got = list(zip(*(part.tolist() for part in P.find_runs(flat, owner)), strict=True))
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        want = [(s + int(bounds[k]), n, q) for k, t in enumerate(texts) for s, n, q in runs_of(t)]
        assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_words_without_runs_and_long_ones():
    # A word without overlaps, whose halves some hashes cannot tell apart.
    thue = np.array([bin(k).count("1") % 2 for k in range(1 << 14)])
    assert not len(P.find_runs(thue, np.zeros(len(thue), np.int64))[0])
    one = np.zeros(100_000, np.int64)
    assert [part.tolist() for part in P.find_runs(one, one)] == [[0], [100_000], [1]]
    rng = np.random.default_rng(1)
    long = np.tile(rng.permutation(9_000), 5)[:44_321]
    assert [part.tolist() for part in P.find_runs(long, np.zeros(len(long), np.int64))] == [[0], [44_321], [9_000]]
    # Fibonacci words have runs of many periods, but of exponent below four.
    a, b = [0], [0, 1]
    while len(b) < 5_000:
        a, b = b, b + a
    assert not len(P.find_runs(np.array(b), np.zeros(len(b), np.int64))[0])


def test_grammar_derives_every_text():
    rng = np.random.default_rng(3)
    words, owner = rng.integers(0, 4, 500), np.sort(rng.integers(0, 7, 500))
    grammar = P.re_pair(words, owner)
    size = grammar.end - grammar.start
    assert len(grammar.node) == 500 - len(set(owner.tolist()))
    for node, place in zip(grammar.node, grammar.place, strict=True):
        one = words[grammar.start[node] : grammar.end[node]]
        assert (words[place : place + size[node]] == one).all() and len(set(owner[place : place + size[node]])) == 1


def awkward():
    line = "to be or not to be that is the question "
    texts = [None, "", " \n\t", "a", "a " * 5, "a " * 6, "A a " * 4, "b c " * 3 + "b c", "x " + "a b " * 9 + "a y", "x y " * 9, line * 3, line * 4]
    texts += ["é " * 8 + "z " + "é " * 8, "\x0b".join("ab" * 12), "p q r " * 5 + "s " + "p q r " * 5, "\x1c " * 7]
    docs = [(k, t) for k, t in enumerate(texts)] + [(None, "a " * 9), (None, None), (3, "a"), (10, line * 4)]
    return docs + [(100 + k, "one two three four five six seven eight nine ten " * 3) for k in range(40)]


def test_awkward_rows(spark):
    frame = spark.createDataFrame([(*d, "clash") for d in awkward()], "doc_id long, text string, runs string").repartition(3)
    got = sorted((tuple(r) for r in P.run_digests(frame).collect()), key=str)
    assert got == sorted((digest(*d) for d in awkward()), key=str)
    assert P.run_digests(frame.limit(0)).count() == 0
    plain = {(r["doc_id"], r["n_words"], r["collapsed"]) for r in P.text_runs(frame).collect() if r["doc_id"] == 8}
    assert plain == {(8, 21, "x a b y")}


def test_query_against_brute_force(spark, small):
    docs = table(spark, small, "documents")
    got = sorted(tuple(r) for r in P.run_digests(docs).collect())
    short = [(r["doc_id"], r["text"]) for r in docs.collect() if len((r["text"] or "").split()) < 3000]
    want = {d: digest(d, t) for d, t in short}
    assert len(got) == docs.count() and len(want) > 150
    assert [g for g in got if g[0] in want] == [want[d] for d in sorted(want)]
    assert any(g[1] for g in got)
