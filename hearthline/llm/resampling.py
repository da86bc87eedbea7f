"""Importance resampling towards a target set, on hashed n-gram counts.

Every text is reduced to words with single spaces between them, and one
overlapped regular expression walks over it: a match begins at every word and
gives the spans of the one, two and three words from there. Each span is
counted in the bucket of its checksum. Buckets of the raw texts and of the
target texts give a gain for each bucket, in whole thousandths; the weight of
a document is the sum of the gains of its features. A draw without replacement
takes the highest sums of weight and Gumbel noise.

Texts are scanned once; their buckets are written to the shared folder, and
the totals and the weights are read from there.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import array_rows, batches, cut, free_name, sum_arrays, text_column

BUCKETS = 10_000
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: Percent of the other documents that are drawn.
PERCENT = 5
SEED = 42
#: Features of a text that are held at once.
CHUNK = 1 << 16

_SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# From the beginning of a word, up to three whole words: the first, the first
# two and all of them are groups.
_GRAMS = regex.compile(rb"(?<![^ ])(([^ ]+)(?: [^ ]+)?)(?: [^ ]+)?(?![^ ])")


def spaced(text: str | None) -> bytes:
    """The words of a text in small letters, with single spaces between them."""
    # bytes.lower changes A-Z only.
    return _SEPARATORS.sub(b" ", (text or "").encode().lower()).strip(b" ")


def features(text: bytes) -> Iterator[bytes]:
    """Runs of one to three words, longest of each word first."""
    for match in _GRAMS.finditer(text, overlapped=True):
        three, two, one = match.group(0, 1, 2)
        yield one
        if len(two) > len(one):
            yield two
            if len(three) > len(two):
                yield three


def bucket_counts(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """(buckets, how many features each holds, words) of a text."""
    line = spaced(text)
    hashed = map(zlib.crc32, features(line))
    words = line.count(b" ") + 1 if line else 0
    total = np.zeros(0, np.int64)
    while True:
        part = np.fromiter(itertools.islice(hashed, CHUNK), np.uint32) % BUCKETS
        if len(part) == CHUNK or len(total):
            # A long text is added up in one array of all buckets.
            total = (total if len(total) else np.zeros(BUCKETS, np.int64)) + np.bincount(part, minlength=BUCKETS)
        if len(part) < CHUNK:
            break
    if len(total):
        found = np.flatnonzero(total)
        return found.astype(np.uint16), total[found], words
    found, counts = np.unique(part, return_counts=True)
    return found.astype(np.uint16), counts, words


_PACKED = "n_words long, n_features long, buckets binary, counts binary"


def _pack_batch(column: str, kept: list[str], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = []
    for text in batch.column(column):
        found, counts, words = bucket_counts(text.as_py())
        most = int(counts.max()) if len(counts) else 0
        width = "<u1" if most < 1 << 8 else "<u4"
        rows.append((words, int(counts.sum()), found.astype("<u2").tobytes(), counts.astype(width).tobytes()))
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)]
    names = ["n_words", "n_features", "buckets", "counts"]
    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *arrays], names=[*kept, *names])


def _unpack(buckets: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(buckets, "<u2")
    width = "<u1" if len(counts) == len(found) else "<u4"
    return found, np.frombuffer(counts, width).astype(np.int64)


def hashed_features(rows: DataFrame, text: str, keep: str | None = None) -> DataFrame:
    """Each row's bucket counts, packed; ``keep`` names a column that stays."""
    kept = [] if keep is None else [keep]
    shape = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in kept) + _PACKED
    column = free_name(kept, text)
    narrow = rows.select(*kept, text_column(rows, text).alias(column))
    return narrow.mapInArrow(batches(lambda batch: _pack_batch(column, kept, batch)), shape)


def _totals(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in stream:
        for row in zip(batch.column("buckets").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            found, counts = _unpack(*row)
            total[found] += counts
    yield array_rows(total)


def bucket_totals(packed: DataFrame) -> np.ndarray:
    """Features of all rows in each bucket; a fixed number of counts."""
    return sum_arrays(packed.select("buckets", "counts").mapInArrow(_totals, "slice int, data binary"), BUCKETS)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight, in whole thousandths."""
    in_source, in_target = float(source.sum()), float(target.sum())
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    ratios = [((t + 1.0) * (in_source + BUCKETS)) / ((s + 1.0) * (in_target + BUCKETS)) for s, t in pairs]
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def noise(doc_id: Column) -> Column:
    """Gumbel noise in whole thousandths from a hash of the id; a null id counts as an empty one."""
    named = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    number = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((number + 0.5) / 4294967296.0))).cast("long")


def weighted(documents: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's id with n_words, n_features and its weight towards the target texts."""
    packed = cut(hashed_features(documents, text, id), "features")
    gain = gains(bucket_totals(packed), bucket_totals(hashed_features(target, text)))

    def add_up(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = zip(batch.column("buckets").to_pylist(), batch.column("counts").to_pylist(), strict=True)
        sums = [int(gain[found] @ counts) for found, counts in (_unpack(*row) for row in rows)]
        kept = [id, "n_words", "n_features"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sums, pa.int64())], names=[*kept, "weight"])

    kind = documents.schema[id].dataType.simpleString()
    return packed.mapInArrow(batches(add_up), f"`{id}` {kind}, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, order: list[Column], eligible: Column, into: str) -> DataFrame:
    """Numbers the eligible rows 1, 2, 3 ... in an order, without one task holding them all.

    Rows are cut into ranges of the order and numbered inside them; a table
    with one row a range adds up what lies before. Other rows get null. Rows
    that are equal in the order are spread by a random number.
    """
    last, tie, place, part, before = (free_name(rows.columns, n) for n in ("_last", "_tie", "_place", "_part", "_before"))
    marked = rows.withColumns({last: ~F.coalesce(eligible, F.lit(False)), tie: F.rand(SEED)})
    along = [F.col(last), *order, F.col(tie)]
    ranges = cut(marked.repartitionByRange(*along).sortWithinPartitions(*along).withColumn(place, F.monotonically_increasing_id()), "ranges")
    ranges = ranges.withColumn(part, F.shiftright(place, 33))
    sizes = ranges.groupBy(part).agg(F.count("*").alias(before))
    # One row a range, as many as there are partitions.
    earlier = F.coalesce(F.sum(before).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select(part, earlier.alias(before)))
    inside = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    number = F.when(~F.col(last), F.col(before) + inside + 1)
    return ranges.join(starts, part).withColumn(into, number.cast("long")).select(*rows.columns, into)


def resample(documents: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents with weight, score, and rank where they are drawn.

    Of the N documents with LEAST_WORDS words or more the floor(PERCENT * N /
    100) highest scores are drawn, ties by smaller id, null ids last. Null and
    empty texts have no features and weight 0. A repeated row is a document of
    its own, with the same score. Other columns of the tables are not read.
    """
    scored = weighted(documents, target, id, text).withColumn("score", F.col("weight") + noise(F.col(id)))
    long_enough = F.col("n_words") >= LEAST_WORDS
    numbered = ranked(scored, [F.desc("score"), F.asc_nulls_last(id)], long_enough, "rank")
    candidates = numbered.agg(F.max("rank")).first()[0] or 0
    return numbered.withColumn("rank", F.when(F.col("rank") <= candidates * PERCENT // 100, F.col("rank")))


def importance_ranks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query: every document's n_features, weight, score and rank."""
    return resample(documents, benchmark).select("doc_id", "n_features", "weight", "score", "rank")
