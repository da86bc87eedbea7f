"""I-Match fingerprints: hashes of a document's mid-frequency terms, in random lexicons.

Terms whose inverse document frequency lies in a band form the lexicon. A
document's distinct lexicon terms, sorted and hashed, are its I-Match value.
Several random subsets of the lexicon, from half of it down to a small part,
give one hash each; two texts are as alike as the share of subsets, among those
in which either has a term, whose hashes agree.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm import words as W
from hearthline.llm.common import array_rows, sum_arrays

#: Terms found in at least, and at most, this share of all documents. The lower
#: bound also bounds the lexicon: documents have so many distinct terms on
#: average, and no more than that number over the bound can reach it.
LOW, HIGH = 0.0005, 0.2
#: Random lexicons for each share kept: a half, a quarter, ...
SHARES, EACH = 8, 8
#: Slots of the first count.
SLOT_BITS = 20
_COUNTED = 1 << 19
#: Characters of a text that ranges of one id are cut at, and texts that the cuts are taken from.
HEAD, SAMPLED = 64, 4096


def _distinct_terms(stream: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The distinct terms of many documents, one document after the other."""
    waiting: list[np.ndarray] = []
    for batch in stream:
        for _, data, bounds in W.pieces(batch.column(0)):
            words = W.find_words(data, bounds, W.ALPHANUMERIC)
            waiting += [np.unique(part) for part in np.split(words.hashes(), words.first[1:-1])]
            if sum(map(len, waiting)) >= _COUNTED:
                yield np.concatenate(waiting)
                waiting.clear()
    if waiting:
        yield np.concatenate(waiting)


def _slot_task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros(1 << SLOT_BITS, np.int64)
    for terms in _distinct_terms(stream):
        sums += np.bincount((terms >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(sums))
    yield array_rows(sums)


def _term_task(shared: Broadcast, stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    heavy = shared.value
    for terms in _distinct_terms(stream):
        found, counts = np.unique(terms[heavy[(terms >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts, pa.int64())], names=["term", "documents"])


def lexicon(texts: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the terms whose share of documents lies in the band; all texts count.

    A first count by slots of a fixed table tells which slots can hold a term
    at the lower bound; only terms of those slots are counted one by one.
    """
    total = texts.count()
    least = max(2.0, low * total)
    slots = sum_arrays(texts.mapInArrow(_slot_task, "slice int, data binary"), 1 << SLOT_BITS)
    heavy = texts.sparkSession.sparkContext.broadcast(slots >= least)
    counts = texts.mapInArrow(functools.partial(_term_task, heavy), "term long, documents long").groupBy("term").agg(F.sum("documents").alias("documents"))
    band = counts.where((F.col("documents") >= least) & (F.col("documents") <= high * total))
    packed = band.select("term").mapInArrow(_pack_terms, "terms binary")
    terms = [np.frombuffer(bytes(row[0]), np.int64) for row in packed.toLocalIterator()]
    return np.sort(np.concatenate(terms).view(np.uint64)) if terms else np.zeros(0, np.uint64)


def _pack_terms(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).to_numpy().tobytes()], pa.binary())], names=["terms"])


class Fingerprinter:
    """I-Match value and subset hashes of texts."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        #: Bit (share, turn) of a term: whether the random lexicon keeps it.
        marks = np.zeros((len(terms), SHARES * EACH), bool)
        for share in range(SHARES):
            for turn in range(EACH):
                k = share * EACH + turn
                marks[:, k] = W.mix(terms + np.uint64(W.mix_int(3000 + k))) >> np.uint64(63 - share) == 0
        self.marks = marks
        #: Sums of these stand for a sorted list of distinct terms.
        self.values = W.mix(terms * np.uint64(5) + np.uint64(11))
        bits = 20
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[(terms >> self.shift).astype(np.int64)] = True

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The I-Match value and the subset hashes (0: no term) of each text."""
        words = W.find_words(data, bounds, W.ALPHANUMERIC)
        hashes, owners = words.hashes(), words.texts
        texts = len(bounds) - 1
        near = self.maybe[(hashes >> self.shift).astype(np.int64)]
        found, at = hashes[near], owners[near]
        if len(self.terms):
            columns = np.searchsorted(self.terms, found).clip(0, len(self.terms) - 1)
            hit = self.terms[columns] == found
        else:
            columns, hit = np.zeros(0, np.int64), np.zeros(0, bool)
        pairs = np.unique(at[hit] * (len(self.terms) + 1) + columns[hit])
        at, columns = pairs // (len(self.terms) + 1), pairs % (len(self.terms) + 1)
        first = np.searchsorted(at, np.arange(texts + 1))
        subsets = np.zeros((texts, SHARES * EACH), np.uint32)
        filled = np.diff(first) > 0
        if filled.any():
            kept = np.where(self.marks[columns], self.values[columns][:, None], np.uint64(0))
            sums = np.add.reduceat(kept, first[:-1][filled], axis=0)
            subsets[filled] = np.where(sums == 0, 0, W.mix(sums) >> np.uint64(32)).astype(np.uint32)
        names = []
        for k in range(texts):
            own = self.terms[columns[first[k] : first[k + 1]]]
            # A text without lexicon terms is named by all its words.
            part = own if len(own) else hashes[words.first[k] : words.first[k + 1]]
            names.append(hashlib.blake2b(part.tobytes(), digest_size=8, person=b"terms" if len(own) else b"words").hexdigest())
        return names, subsets


def likeness(one: tuple[str, np.ndarray], other: tuple[str, np.ndarray]) -> float:
    """1 for equal I-Match values, else the share of subsets with a term whose hashes agree."""
    if one[0] == other[0]:
        return 1.0
    either = (one[1] != 0) | (other[1] != 0)
    return float((one[1] == other[1])[either].mean()) if either.any() else 0.0


def written(value: tuple[str, np.ndarray]) -> str:
    """A fingerprint as text: the I-Match value, then 16 bits of each subset hash."""
    return value[0] + "".join(f"{h >> 16:04x}" for h in value[1].tolist())


def _edited(text: str, following: str) -> str:
    count = len(text) // 3
    return text[: len(text) - count] + following[:count]


_ROWS = "id {id}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare_stream(shared: Broadcast, stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range, then in order; a range ends with the first row of the next."""
    printer = Fingerprinter(shared.value)
    names = [part.split()[0] for part in _ROWS.split(", ")]

    def prints(texts: list[str]) -> list[tuple[str, np.ndarray]]:
        out = []
        for _, data, bounds in W.pieces(pa.array(texts, pa.large_string())):
            found, subsets = printer(data, bounds)
            out += zip(found, subsets, strict=True)
        return out

    held: list | None = None
    for batch in stream:
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            rows = list(zip(*(part.column(c).to_pylist() for c in ("range", "id", "text", "guest")), strict=True))
            marks = prints([r[2] for r in rows])
            out = []
            pairs = []
            for row, mark in zip(rows, marks, strict=True):
                if held is not None and held[0][0] == row[0]:
                    pairs.append((*held, row, mark))
                held = None if row[3] else (row, mark)
            edits = [_edited(one[2], other[2]) for one, _, other, _ in pairs]
            for (one, mark, _, next_mark), text, edit_mark in zip(pairs, edits, prints(edits), strict=True):
                out.append((one[1], len(one[2]), hashlib.sha256(text.encode()).hexdigest(), written(mark), written(edit_mark), likeness(mark, edit_mark), likeness(mark, next_mark)))
            if out:
                id_, *columns = zip(*out, strict=True)
                kinds = (pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)
                arrays = [pa.array(id_, part.schema.field("id").type), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)


def _key(docs: DataFrame) -> Column:
    """The id in the form that edges are given in: numbers as double, others as they are."""
    return F.col("id").cast("double") if isinstance(docs.schema["id"].dataType, T.NumericType) else F.col("id")


def _edges(docs: DataFrame, ranges: int) -> list:
    """Ids that cut the rows into ranges of about as many, in order; an id of many rows comes repeatedly.

    Numbers by their quantiles, ids of other types by a sample of SAMPLED rows:
    only the sizes of the ranges depend on it.
    """
    ids = docs.select("id").where("id is not null")
    if isinstance(docs.schema["id"].dataType, T.NumericType):
        return ids.approxQuantile("id", [k / ranges for k in range(1, ranges)], 0.2 / ranges) if ids.take(1) else []
    sample = sorted(row[0] for row in ids.orderBy(F.rand(7)).limit(SAMPLED).collect())
    return [sample[k * len(sample) // ranges] for k in range(1, ranges)] if sample else []


def _heads(docs: DataFrame, edges: list, ranges: int) -> dict[object, list[str]]:
    """For each id that fills several ranges, null among them, the heads of texts that cut it."""
    nulls, rows = docs.agg(F.count_if(F.col("id").isNull()), F.count("*")).first()
    # From 2^53 on a quantile may stand for several ids.
    several = {id: n for id, n in Counter(edges).items() if n > 1 and not (isinstance(id, float) and abs(id) >= 1 << 53)}
    if nulls * ranges > rows:
        several[None] = -(-nulls * ranges // rows)
    if not several:
        return {}
    key = _key(docs)
    wanted = key.isin([id for id in several if id is not None])
    sample = docs.where(key.isNull() | wanted).select(key.alias("id"), F.substring("text", 1, HEAD).alias("head"))
    found: dict[object, list[str]] = {}
    for row in sample.orderBy(F.rand(7)).limit(SAMPLED).collect():
        found.setdefault(row["id"], []).append(row["head"])
    cuts = {}
    for id, texts in found.items():
        texts.sort()
        n = several.get(id, 1)
        cuts[id] = sorted({texts[k * len(texts) // n] for k in range(1, n)} - {""})
    return {id: texts for id, texts in cuts.items() if texts}


def with_next(docs: DataFrame) -> DataFrame:
    """(range, id, text, guest): documents in ranges of descending id, null last.

    The first document of each range also closes the one before as a guest, and
    the very first closes the last, so that every document is followed by its
    next one in the same range. Ties of id are ordered by text, and an id of
    very many rows, or none, has ranges of its own, cut by text. Only ids and
    some texts' heads are read to find the ranges; texts move once.
    """
    spark = docs.sparkSession
    ranges = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cutting = _edges(docs, ranges)
    edges = sorted(set(cutting))
    heads = _heads(docs, cutting, ranges)
    # Ranges count from the highest ids; rows without an id come last of all.
    number = F.lit(len(edges))
    if edges:
        number = F.lit(len(edges)) - F.size(F.filter(F.lit(edges), lambda edge: edge < F.col("id")))
    number = F.when(F.col("id").isNull(), F.lit(len(edges) + 1)).otherwise(number).cast("long")
    # An id that is an edge has the highest place in its range; the others come after its texts.
    cuts = F.lit(None).cast("array<string>")
    known = [F.lit(x) for id, texts in heads.items() if id is not None for x in (id, texts)]
    if known:
        cuts = F.create_map(*known)[_key(docs)]
    if None in heads:
        cuts = F.when(F.col("id").isNull(), F.lit(heads[None])).otherwise(cuts)
    inside = F.when(cuts.isNotNull(), F.size(F.filter(cuts, lambda head: head <= F.col("text")))).otherwise(F.lit(ranges))
    placed = docs.withColumn("range", number * (ranges + 1) + inside)
    firsts = placed.groupBy("range").agg(F.max("id").alias("first")).orderBy("range").collect()
    if not firsts:
        return placed.select("range", "id", "text", F.lit(False).alias("guest"))
    present = [r["range"] for r in firsts]
    before = {r: present[k - 1] for k, r in enumerate(present)}
    starts = {r["range"]: r["first"] for r in firsts}
    as_map = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    start_map = F.create_map(*[F.lit(x) for pair in starts.items() if pair[1] is not None for x in pair]) if any(v is not None for v in starts.values()) else None
    first = F.col("id").isNull() if start_map is None else F.coalesce(F.col("id") == start_map[F.col("range")], F.col("id").isNull())
    guests = placed.where(first).groupBy("range").agg(F.max("id").alias("id"), F.min("text").alias("text"))
    guests = guests.select(as_map[F.col("range")].alias("range"), "id", "text", F.lit(True).alias("guest"))
    return placed.select("range", "id", "text", F.lit(False).alias("guest")).union(guests)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Documents follow each other by descending id, null ids last, equal ids by
    text; after the last comes the first. Ids may be numbers, texts (in code
    point order), dates or timestamps. The edited text is the text with its
    last third (rounded down) replaced by as many characters of the next one,
    or all it has. Null text is empty. Equal texts have equal fingerprints; a
    text without lexicon terms is named by its words.
    """
    docs = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    terms = docs.sparkSession.sparkContext.broadcast(lexicon(docs.select("text"), low, high))
    kind = docs.schema["id"].dataType.simpleString()
    placed = with_next(docs)
    placed = placed.repartition("range").sortWithinPartitions("range", "guest", F.col("id").desc_nulls_last(), "text")
    return placed.mapInArrow(functools.partial(_compare_stream, terms), _ROWS.format(id=kind))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    return fingerprints(docs).withColumnRenamed("id", "doc_id")
