from __future__ import annotations

import itertools
import re

from hearthline.llm import licenses as L
from hearthline.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    """The contract's base columns, word by word."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    places = [
        (k, label) for phrase, label in L.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()
    ]
    starts = [k for k, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def test_base_columns(spark, small):
    docs = table(spark, small, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = L.license_labels(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain(texts[r["doc_id"]])
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1


def test_awkward_rows(spark):
    texts = [None, "", "CC BY cc-by cc by", "ALL RIGHTS RESERVED", "all rights", "ccby by cc", "é cc by ü " * 3, "x" * 200_000 + " cc by", "\x00cc\x00by"]
    docs = spark.createDataFrame([(None if k == 4 else k % 3, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, n_words string")
    rows = L.license_labels(docs).collect()
    want = sorted((plain(t) for t in texts), key=str)
    assert sorted(((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows), key=str) == want
    assert L.license_labels(docs.where("false")).collect() == []


def labels(text):
    return {rule.label for _, _, rule in L.detections(L.normal(text.encode()))}


def test_signatures():
    assert labels("Licensed under CC BY-NC 4.0.") >= {"cc-by-nc-4.0"}
    assert "cc-by-nc" not in labels("Licensed under CC BY-NC 4.0.")
    assert labels("under the Apache License, Version 2.0 (the") >= {"apache-2.0"}
    assert labels("GNU General Public License version 3 or any later version") == {"gpl-3-or-later"}
    assert labels("the BSD 3-Clause License") == {"bsd-3-clause"}
    assert labels("SPDX-License-Identifier: MIT License") == {"spdx"}
    assert labels("Copyright (c) 2019 A. Author") == {"copyright"}
    assert labels("admitlicense or apacheria") == set()


def test_every_rule_can_match():
    """Each pattern compiles, and its keyword is needed by what it matches."""
    gated = [x for part in L._gated().values() for x in part]
    assert len(gated) == len(L.rules()) > 200


def samples(tree):
    """Texts that a parsed pattern matches: every branch, every member of a class, fewest and one more repeats."""
    parts = []
    for kind, value in tree:
        kind = str(kind)
        if kind == "LITERAL":
            parts.append([chr(value)])
        elif kind == "IN":
            parts.append([chr(v if str(k) == "LITERAL" else v[0]) if str(k) in ("LITERAL", "RANGE") else {"CATEGORY_DIGIT": "7", "CATEGORY_WORD": "x"}[str(v)] for k, v in value])
        elif kind == "BRANCH":
            parts.append([x for branch in value[1] for x in samples(branch)])
        elif kind == "SUBPATTERN":
            parts.append(list(samples(value[3])))
        else:
            assert kind == "MAX_REPEAT"
            low, high, sub = value
            parts.append(["".join(x) for n in {low, min(low + 1, int(high))} for x in itertools.product(samples(sub), repeat=n)])
    return map("".join, itertools.product(*parts))


def test_keywords_are_in_all_that_their_patterns_match():
    for rule in L.rules():
        for text in itertools.islice(samples(re._parser.parse(rule.pattern)), 5000):
            assert re.fullmatch(rule.pattern, text)
            assert rule.keyword in f" {text} ", (rule, text)
    assert labels("under the MIT Licence") == {"mit"}
    assert labels("ISC Licence") == {"isc"}
    assert labels("same terms as Perl 5 itself") == {"perl"}


def test_contained_detections_are_suppressed():
    words = L.normal(b"gnu lesser general public license version 2.1 or any later version")
    kept = L.detections(words)
    assert {rule.label for _, _, rule in kept} == {"lgpl-2.1-or-later"}
