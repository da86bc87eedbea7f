from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from oracle import connect, difference
from pyspark.sql import functions as F

from hearthline.llm import line_dedup, mixing, queries

WHITE = " \t\n\v\f\r"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, small, name):
    assert difference(queries.QUERIES[name](spark, small), connect(small), queries.SQL[name]) is None


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def kept_lines(docs, min_docs, keep_first):
    places = defaultdict(list)
    for doc in sorted(set(docs), key=lambda d: (d[0] is not None, d[0], d[1] or "")):
        for k, line in enumerate((doc[1] or "").split("\n")):
            if key_of(line):
                places[key_of(line)].append((doc, k))
    gone = set()
    for found in places.values():
        if len({doc for doc, _ in found}) >= min_docs:
            gone |= set(found[1:] if keep_first else found)
    return {doc: "\n".join(line for k, line in enumerate((doc[1] or "").split("\n")) if (doc, k) not in gone) for doc in docs}


def awkward():
    docs = [(k, f"Shared Line\n own {k}\n\n \t\n  shared line\t\nx") for k in range(4)]
    docs += [(9, None), (10, ""), (None, "Shared line\nno id"), (12, "x\ny"), (12, "x\ny"), (13, "\n".join(f"line {k}" for k in range(300)) + "\nX")]
    return docs


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("min_docs", [2, 4, 5])
def test_lines_against_brute_force(spark, keep_first, min_docs):
    docs = awkward()
    frame = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, position string")
    rows = line_dedup.drop_repeated_lines(frame, min_docs=min_docs, keep_first=keep_first).collect()
    got = sorted(((r["doc_id"], r["text"], r["kept"], r["n_lines"] - r["n_dropped"]) for r in rows), key=str)
    want = kept_lines(docs, min_docs, keep_first)
    if not keep_first:
        counted = [(i, t, want[i, t], want[i, t].count("\n") + 1 if want[i, t] or (t or "") in ("", want[i, t]) else 0) for i, t in docs]
        assert got == sorted(counted, key=str)
    # Which place is the first depends on the documents' order, which is by id and then by a hash.
    elif all(i is not None for i, _ in docs):
        assert [g[2] for g in got] == [want[g[0], g[1]] for g in got]
    else:
        shared = sum(key_of(line) == "shared line" for r in rows for line in r["kept"].split("\n"))
        assert shared == (1 if min_docs <= 5 else 9)


def test_rewrite_keeps_columns_and_null_text(spark):
    frame = spark.createDataFrame([(i, t, "en", "s", -1) for i, t in awkward()], "doc_id long, text string, lang string, source string, n_chars long")
    out = line_dedup.rewrite(frame, min_docs=4)
    assert out.schema.names == frame.schema.names
    rows = {(r["doc_id"]): r for r in out.collect()}
    assert rows[9]["text"] is None and rows[9]["n_chars"] == -1
    assert rows[0]["text"] == " own 0\n\n \t" and rows[0]["n_chars"] == len(rows[0]["text"])
    assert line_dedup.rewrite(frame.where("false")).collect() == []


def words(text):
    return len([w for w in "".join(" " if c in WHITE else c for c in text or "").split(" ") if w])


def fair_targets(sizes):
    """Reshare the excess until no source is above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / max(1, sum(weight[s] for s in left))
        over = [s for s in left if level * weight[s] > 3 * sizes[s]]
        if not over:
            return {s: capped.get(s, level * weight[s]) for s in names}
        capped |= {s: 3 * sizes[s] for s in over}


def test_mix_meets_targets(spark):
    docs = [(k, "w " * (k % 7), f"s{k % 3}") for k in range(200)] + [(300, "a b c", None), (None, "no id here", None), (301, None, "empty"), (302, "", "empty")]
    docs += [(303, "twice said", "s1")] * 2 + [(304, "long " * 20_000, "big")]
    frame = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, source string, size string")
    rows = mixing.mix(frame).collect()
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += words(text)
    targets = fair_targets(sizes)
    by_target = defaultdict(lambda: [0, 0])
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_target[r["source_size"], round(r["target"], 6)][0] += r["taken"]
    want = defaultdict(int)
    for source, size in sizes.items():
        want[size, round(targets[source], 6)] += int(targets[source] + 1e-9)
    assert {k: v[0] for k, v in by_target.items()} == dict(want)
    assert len(rows) == len(docs) and sorted(map(str, rows)) == sorted(map(str, mixing.mix(frame.repartition(7)).collect()))


def test_take_repeats_rows(spark):
    frame = spark.createDataFrame([(k, "w " * 5, "small" if k < 5 else "z", -k) for k in range(100)], "doc_id long, text string, source string, copies long")
    out = mixing.take(frame)
    assert out.schema.names == frame.schema.names
    taken = {r["id"]: -(-r["taken"] // r["size"]) for r in mixing.mix(frame).collect()}
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {k: n for k, n in taken.items() if n}
    assert mixing.take(frame.where("false")).collect() == []


def test_digest_columns(spark):
    frame = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    row = line_dedup.line_digest(frame).first()
    assert tuple(row) == (1, 2, 0, hashlib.sha256(b"a\nb").hexdigest())
    assert line_dedup.line_digest(frame.where(F.lit(False))).collect() == []
