"""License scan: ordered signature rules, gated by keywords, overlaps resolved.

A text is taken as its words, A-Z as small letters, one space apart. Every rule
is a regular expression over that, with a label, a priority and a keyword. Only
rules whose keyword occurs in the text are tried. A detection that lies inside
another of the same or a higher priority is suppressed.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm import words as W
from hearthline.llm.common import batches

#: The phrases and labels that are always reported; fixed values.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Priorities: a full notice, a named version, a named license, a hint.
NOTICE, VERSION, NAME, HINT = 4, 3, 2, 1
CONFIDENCE = {NOTICE: 1.0, VERSION: 0.95, NAME: 0.8, HINT: 0.4}
BASE_CONFIDENCE = 0.5


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: str


def _spaced(version: str) -> str:
    return version.replace(".", " ")


def _versioned(label: str, keyword: str, names: Iterable[str], versions: Iterable[str], between: str = " (?:license )?(?:version |v)?") -> Iterator[Rule]:
    """A license under each of its names, by itself and with each version."""
    for name in names:
        for version in versions:
            yield Rule(f"{label}-{version}", VERSION, keyword, f"{name}{between}{_spaced(version)}")
        yield Rule(label, NAME, keyword, name)


def _creative_commons() -> Iterator[Rule]:
    parts = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?(?: works)?", "nc": "non ?commercial"}
    for kind in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"):
        short = "cc " + kind.replace("-", " ")
        long = "creative commons " + " ".join(parts[p] for p in kind.split("-"))
        for keyword, name in (("cc by", short), ("creative commons", long)):
            for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
                yield Rule(f"cc-{kind}-{version}", VERSION, keyword, f"{name}(?: license)? {_spaced(version)}(?: (?:international|unported|generic))?")
            yield Rule(f"cc-{kind}", NAME, keyword, name)
        yield Rule(f"cc-{kind}", VERSION, "creativecommons", f"creativecommons org licenses {kind.replace('-', ' ')}(?: \\d \\d)?")
    yield Rule("cc0", VERSION, "cc0", "cc0(?: 1 0)?(?: universal)?")
    yield Rule("cc0", VERSION, "creative commons", "creative commons zero(?: v?1 0)?")
    yield Rule("cc0", VERSION, "publicdomain", "creativecommons org publicdomain zero")


def _gnu() -> Iterator[Rule]:
    later = " or (?:any |\\(?at your option\\)? ?any )?later(?: version)?"
    for label, long, short, versions in (
        ("gpl", "general public license", "gpl", ("1", "2", "3")),
        ("lgpl", "(?:lesser|library) general public license", "lgpl", ("2", "2.1", "3")),
        ("agpl", "affero general public license", "agpl", ("1", "3")),
        ("gfdl", "free documentation license", "gfdl", ("1.1", "1.2", "1.3")),
    ):
        keyword = long.rsplit(") ", 1)[-1] if long.startswith("(") else long
        for version in versions:
            digits = _spaced(version) + "(?: 0)?"
            for word, name in ((keyword, f"(?:gnu )?{long}(?: \\w?gpl)? (?:version |v)?{digits}"), (short, f"(?:gnu )?{short} ?(?:version |v ?)?{digits}")):
                yield Rule(f"{label}-{version}-or-later", NOTICE, word, f"{name}(?: of the license)?{later}")
                yield Rule(f"{label}-{version}-or-later", NOTICE, word, f"{name} or (?:newer|above)")
                yield Rule(f"{label}-{version}", VERSION, word, f"{name}(?: only)?")
        yield Rule(label, NAME, keyword, f"(?:gnu )?{long}")
        yield Rule(label, NAME, short, f"(?:gnu )?{short}(?:ed)?")


def _named() -> Iterator[Rule]:
    yield from _versioned("apache", "apache", ("apache(?: software)? licen[cs]e", "apache"), ("1.0", "1.1", "2.0"), " (?:version |v)?")
    yield from _versioned("mpl", "mozilla", ("mozilla public licen[cs]e",), ("1.0", "1.1", "2.0"))
    yield from _versioned("mpl", "mpl", ("mpl",), ("1.0", "1.1", "2.0"))
    yield from _versioned("epl", "eclipse", ("eclipse public licen[cs]e",), ("1.0", "2.0"))
    yield from _versioned("cddl", "distribution license", ("common development and distribution license",), ("1.0", "1.1"))
    yield from _versioned("cpl", "common public", ("common public license",), ("0.5", "1.0"))
    yield from _versioned("eupl", "european union", ("european union public licen[cs]e",), ("1.0", "1.1", "1.2"))
    yield from _versioned("eupl", "eupl", ("eupl",), ("1.0", "1.1", "1.2"))
    yield from _versioned("osl", "open software license", ("open software license",), ("1.0", "2.0", "2.1", "3.0"))
    yield from _versioned("afl", "academic free", ("academic free license",), ("1.2", "2.0", "2.1", "3.0"))
    yield from _versioned("artistic", "artistic license", ("artistic license",), ("1.0", "2.0"))
    yield from _versioned("bsl", "boost software", ("boost software license",), ("1.0",))
    yield from _versioned("ofl", "open font", ("(?:sil )?open font license",), ("1.0", "1.1"))
    yield from _versioned("lppl", "latex project", ("latex project public license",), ("1.0", "1.1", "1.2", "1.3a", "1.3c"))
    yield from _versioned("zpl", "zope", ("zope public license",), ("1.1", "2.0", "2.1"))
    yield from _versioned("php", "php license", ("php license",), ("3.0", "3.01"))
    yield from _versioned("python", "python", ("python(?: software foundation)? license",), ("2.0", "2.0.1"))
    yield from _versioned("cecill", "cecill", ("cecill(?: [bc])?",), ("1.0", "1.1", "2.0", "2.1"))
    yield from _versioned("odbl", "open database", ("open database license",), ("1.0",))
    yield from _versioned("odc-by", "open data commons", ("open data commons attribution(?: license)?",), ("1.0",))
    yield from _versioned("pddl", "public domain dedication", ("(?:open data commons )?public domain dedication and licen[cs]e",), ("1.0",))
    yield from _versioned("sspl", "server side", ("server side public license",), ("1",))
    yield from _versioned("busl", "business source", ("business source license",), ("1.0", "1.1"))
    yield from _versioned("elastic", "elastic license", ("elastic license",), ("2.0",))
    yield from _versioned("ms-pl", "microsoft public", ("microsoft public license",), ())
    yield from _versioned("ms-rl", "microsoft reciprocal", ("microsoft reciprocal license",), ())
    for clauses, words in (("0", "zero"), ("1", "one"), ("2", "two"), ("3", "three"), ("4", "four")):
        yield Rule(f"bsd-{clauses}-clause", VERSION, "bsd", f"bsd (?:{clauses}|{words}) clause(?: license)?")
        yield Rule(f"bsd-{clauses}-clause", VERSION, "bsd", f"(?:{clauses}|{words}) clause bsd(?: license)?")
    yield Rule("bsd-2-clause", VERSION, "bsd", "(?:simplified|freebsd) bsd license")
    yield Rule("bsd-3-clause", VERSION, "bsd", "(?:new|modified|revised) bsd license")
    yield Rule("bsd-4-clause", VERSION, "bsd", "(?:original|old) bsd license")
    yield Rule("0bsd", VERSION, "0bsd", "0bsd")
    for label, keyword, pattern in (
        ("mit", "mit licen", "(?:the )?(?:expat )?mit licen[cs]e"),
        ("mit", "mit style", "mit style licen[cs]e"),
        ("mit", "licensed under mit", "licensed under mit"),
        ("mit", "expat", "expat license"),
        ("mit", "x11 license", "x11 license"),
        ("bsd", "bsd", "bsd(?: style)? licen[cs]e"),
        ("isc", "isc licen", "isc licen[cs]e"),
        ("zlib", "zlib", "zlib(?: libpng)? license"),
        ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source license"),
        ("unlicense", "unlicense", "(?:the )?unlicense"),
        ("wtfpl", "wtfpl", "wtfpl"),
        ("wtfpl", "what the", "do what the \\w+ you want to public license"),
        ("beerware", "beer", "beer ?ware license"),
        ("json", "good not evil", "used for good not evil"),
        ("postgresql", "postgresql", "postgresql license"),
        ("ruby", "ruby license", "ruby license"),
        ("perl", "same terms as perl", "same terms as perl(?: \\d+)? itself"),
        ("openssl", "openssl", "openssl license"),
        ("curl", "curl license", "curl license"),
        ("vim", "vim license", "vim license"),
        ("icu", "icu license", "icu license"),
        ("unicode", "unicode", "unicode(?: inc)? license agreement"),
        ("w3c", "w3c", "w3c software(?: notice and)? license"),
        ("hpnd", "historical permission", "historical permission notice and disclaimer"),
        ("upl", "universal permissive", "universal permissive license"),
        ("blueoak", "blue oak", "blue oak model license"),
        ("commons-clause", "commons clause", "commons clause"),
        ("openrail", "openrail", "(?:bigscience )?openrail(?: m)?"),
        ("kopimi", "kopimi", "kopimi"),
        ("crown", "open government", "open government licen[cs]e"),
        ("crown", "crown copyright", "crown copyright"),
        ("etalab", "licence ouverte", "licence ouverte"),
    ):
        yield Rule(label, NAME, keyword, pattern)


def _notices() -> Iterator[Rule]:
    for label, keyword, pattern in (
        ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
        ("isc", "permission to use copy", "permission to use copy modify and or distribute this software for any purpose"),
        ("bsd", "redistribution and use", "redistribution and use in source and binary forms(?: with or without modification)?(?: are permitted)?"),
        ("bsl", "machine executable object", "machine executable object code generated by a source language processor"),
        ("unlicense", "unencumbered", "free and unencumbered software released into the public domain"),
        ("zlib", "altered source versions", "altered source versions must be plainly marked as such"),
        ("apache", "you may not use this file", "you may not use this file except in compliance with the license"),
        ("mpl", "source code form is subject", "this source code form is subject to the terms of the mozilla public license(?: v 2 0)?"),
        ("gpl", "redistribute it and or modify", "you can redistribute it and or modify it under the terms of the gnu(?: \\w+)? general public license"),
        ("gfdl", "copy distribute and or modify", "permission is granted to copy distribute and or modify this document"),
        ("public-domain", "public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
        ("no-copying", "no part of this", "no part of this (?:\\w+ ){1,4}may be reproduced"),
        ("personal-use", "for personal", "for personal(?: and)? non ?commercial use only"),
    ):
        yield Rule(label, NOTICE, keyword, pattern)
    yield Rule("spdx", NOTICE, "spdx license identifier", "spdx license identifier (?:\\w+ ?){1,4}")
    for label, keyword, pattern in (
        ("copyright", "copyright", "copyright(?: c)?(?: ©)? (?:19|20)\\d\\d(?: (?:19|20)\\d\\d)?"),
        ("copyright", "copyright", "copyright by"),
        ("copyright", "copyright", "(?:droits d auteur|derechos de autor|urheberrecht) copyright"),
        ("public-domain", "public domain", "public domain"),
        ("permission", "used with permission", "used with permission"),
        ("permission", "used by permission", "used by permission"),
        ("warranty", "without warranty", "without warranty of any kind"),
        ("warranty", "as is", "provided as is(?: without)?(?: express or implied)?"),
        ("proprietary", "proprietary", "proprietary and confidential"),
        ("proprietary", "trade secret", "trade secrets? (?:of|and)"),
        ("terms", "terms of use", "subject to the terms of use"),
        ("terms", "terms of service", "subject to the terms of service"),
        ("reserved-es", "todos los derechos reservados", "todos los derechos reservados"),
        ("reserved-fr", "tous droits", "tous droits réservés"),
        ("reserved-de", "alle rechte vorbehalten", "alle rechte vorbehalten"),
        ("dual", "dual licensed", "dual licensed"),
        ("licensed", "licensed under", "licensed under(?: the)?(?: terms of)?(?: the)? \\w+"),
        ("licensed", "distributed under", "distributed under the(?: terms of the)? \\w+ license"),
        ("licensed", "under the terms of", "under the terms of the \\w+ licen[cs]e"),
    ):
        yield Rule(label, HINT, keyword, pattern)


@functools.cache
def rules() -> tuple[Rule, ...]:
    """All rules in order; the base phrases are rules too."""
    base = (Rule(label, NAME, phrase, phrase) for phrase, label in BASE.items())
    return (*base, *_notices(), *_creative_commons(), *_gnu(), *_named())


@functools.cache
def _gated() -> dict[bytes, list[tuple[int, Rule, re.Pattern[bytes]]]]:
    out: dict[bytes, list] = {}
    for k, rule in enumerate(rules()):
        # Whole words: patterns lie between spaces.
        pattern = re.compile(b"(?<= )" + b"(?:" + rule.pattern.encode().replace(b"\\w", b"[0-9a-z\x80-\xff]") + b")(?= )")
        out.setdefault(rule.keyword.encode(), []).append((k, rule, pattern))
    return out


#: Every byte as in a normal text: small letters, and spaces between words.
_NORMAL = bytes(int(W.LOWER[b]) if W.ALPHANUMERIC[b] else 32 for b in range(256))


def normal(text: bytes) -> bytes:
    """The words of a text one space apart, with a space at either end."""
    return b" " + b" ".join(text.translate(_NORMAL).split()) + b" "


def base_places(words: bytes) -> list[tuple[int, str]]:
    """(byte, label) of every place of a base phrase, overlapping ones too."""
    found = []
    for phrase, label in BASE.items():
        wanted, at = f" {phrase} ".encode(), -1
        while (at := words.find(wanted, at + 1)) >= 0:
            found.append((at, label))
    return found


def detections(words: bytes) -> list[tuple[int, int, Rule]]:
    """(first byte, last byte, rule) of what no other detection suppresses.

    In order of start, the longest first, a detection is suppressed if one
    before it of the same or a higher priority reaches as far."""
    found = []
    for keyword, gated in _gated().items():
        if keyword in words:
            for k, rule, pattern in gated:
                found += [(m.start(), -m.end(), -rule.priority, k, rule) for m in pattern.finditer(words)]
    kept, reach = [], dict.fromkeys(CONFIDENCE, -1)
    for start, end, _, _, rule in sorted(found, key=lambda d: d[:4]):
        if all(far < -end for priority, far in reach.items() if priority >= rule.priority):
            kept.append((start, -end, rule))
        reach[rule.priority] = max(reach[rule.priority], -end)
    return kept


_SCAN = (
    "id {id}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "detections array<struct<label:string,first_word:long,n_words:long,priority:int>>"
)


def _scan_text(words: bytes) -> tuple:
    base = base_places(words)
    kept = detections(words)
    if not base and not kept:
        return 0, None, None, "", "", 0.0, []
    # Word k follows space k.
    spaces = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts = np.searchsorted(spaces, [at for at, _ in base]).tolist()
    base_labels = sorted({label for _, label in base})
    labels = sorted({*base_labels, *(rule.label for _, _, rule in kept)})
    score = max([BASE_CONFIDENCE if base else 0.0, *(CONFIDENCE[rule.priority] for _, _, rule in kept)])
    ends = np.searchsorted(spaces, [[a, b] for a, b, _ in kept]).tolist() if kept else []
    spans = [{"label": rule.label, "first_word": a - 1, "n_words": b - a + 1, "priority": rule.priority} for (a, b), (_, _, rule) in zip(ends, kept, strict=True)]
    return len(base), min(starts, default=None), max(starts, default=None), ",".join(base_labels), ",".join(labels), score, spans


def _scan_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    spans = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("priority", pa.int32())]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), spans)
    for place, data, bounds in W.pieces(batch.column(1)):
        counts = W.find_words(data, bounds, W.ALPHANUMERIC).counts
        whole = data.tobytes()
        rows = [_scan_text(normal(whole[a:b])) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        arrays = [batch.column(0)[place], pa.array(counts.astype(np.int64)), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))]
        names = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections), a row a document.

    ``n_base`` counts all places of base phrases, ``first_word`` and
    ``last_word`` are their smallest and largest start (words from 0, else
    null). ``labels`` adds those of the detections that stay; base labels are
    never suppressed. ``score`` is the confidence of the surest detection, 0
    without any. Null and empty texts have no words. Each row is scanned by
    itself.
    """
    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(batches(_scan_batch), _SCAN.format(id=kind))


def license_labels(docs: DataFrame) -> DataFrame:
    return scan(docs).drop("detections").withColumnRenamed("id", "doc_id")
