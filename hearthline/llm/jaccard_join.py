"""Exact Jaccard similarity join of word shingle sets, by prefixes under several orders.

If two sets are similar enough, then under *any* total order of tokens their
prefixes (a tenth of the set for 0.9) share a token. Several orders are used: in
each, tokens are ranked by how crowded their slot of a counting sketch over the
whole corpus is, then by hash, and each order has its own hash. So tokens of a
passage that very many texts share come last and stay out of prefixes.

Pairs that share a prefix token under the first order must share one under
every other order as well, and pass bounds on size and on a parity bitmap,
before their sets are compared. All bounds are exact; no candidate is dropped
otherwise.

Groups of near copies are never expanded into all pairs. Equal sets are one
node. Each token's texts are first compared with one of them, the one with the
fewest tokens of its own, and verified links are contracted. What is left are
pairs from different components, taken as pairs of components per token first.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm import words as W
from hearthline.llm.common import array_rows, batches, components, cut, free_name, sum_arrays, text_column

#: Token orders, and slots of each one's counting sketch.
ORDERS = 3
SKETCH_BITS = 20
PARITY_WORDS = 16
#: Entries of the inverted prefixes that are worked on at once.
_HELD = 1 << 20
#: Slots of the bitmap of documents whose sets are made again.
WANTED_BITS = 22
#: Tokens counted at once.
_COUNTED = 1 << 20


def _order_hash(tokens: np.ndarray, order: int) -> np.ndarray:
    return W.mix(tokens + np.uint64(W.mix_int(1000 + order)))


def _count_task(size: int, orders: int, bits: int, stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    slots = 1 << bits
    sums = np.zeros((orders, slots), np.int64)
    waiting: list[np.ndarray] = []

    def count() -> None:
        tokens = np.concatenate(waiting)
        waiting.clear()
        for order in range(orders):
            sums[order] += np.bincount((_order_hash(tokens, order) >> np.uint64(64 - bits)).astype(np.int64), minlength=slots)

    held = 0
    for batch in stream:
        for _, data, bounds in W.pieces(batch.column(0)):
            sets = W.shingles(W.find_words(data, bounds, W.PLAIN), size)
            waiting += sets
            held += sum(map(len, sets))
            if held >= _COUNTED:
                count()
                held = 0
    if waiting:
        count()
    yield array_rows(sums.ravel())


def token_classes(texts: DataFrame, size: int, orders: int = ORDERS, bits: int = SKETCH_BITS) -> np.ndarray:
    """For each order and slot of its sketch a class 0..255, rising with the slot's count.

    Counts cover every shingle of all texts. The sketch has a fixed size, so it
    may be broadcast; in a larger corpus a slot is shared by more tokens, and
    those that hold a certain share of the corpus still stand out.
    """
    rows = texts.mapInArrow(functools.partial(_count_task, size, orders, bits), "slice int, data binary")
    counts = sum_arrays(rows, orders << bits).reshape(orders, 1 << bits)
    classes = np.zeros(counts.shape, np.uint8)
    for order in range(orders):
        steps = np.unique(np.quantile(counts[order], np.arange(1, 256) / 256, method="lower"))
        classes[order] = np.searchsorted(steps, counts[order], "left").clip(0, 255)
    return classes


def prefix_length(n: int, percent: int) -> int:
    """Tokens of a set of n, under any order, of which a similar enough set has one."""
    return n - -(-n * percent // 100) + 1


def _prefixes(tokens: np.ndarray, classes: np.ndarray, percent: int) -> list[np.ndarray]:
    bits = 64 - int(math.log2(classes.shape[1]))
    wanted = prefix_length(len(tokens), percent)
    out = []
    for order in range(len(classes)):
        hashes = _order_hash(tokens, order)
        # One number to sort by: the class, then the hash.
        rank = (classes[order][(hashes >> np.uint64(bits)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (W.mix(hashes) >> np.uint64(8))
        chosen = np.argpartition(rank, wanted - 1)[:wanted] if wanted < len(tokens) else slice(None)
        # The first order's tokens are joined on; of the others it is enough to
        # know that two prefixes may meet, so half of each token is kept.
        out.append(tokens[chosen].view(np.int64) if order == 0 else (tokens[chosen] >> np.uint64(32)).astype(np.uint32).view(np.int32))
    return out


def _parity(sets: list[np.ndarray]) -> list[np.ndarray]:
    """A bitmap of each set: bit b is the parity of its tokens that fall on b."""
    bits = 64 * PARITY_WORDS
    shift = np.uint64(64 - int(math.log2(bits)))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    places = (np.concatenate(sets) >> shift).astype(np.int64) if sets else np.zeros(0, np.int64)
    odd = np.bincount(owner * bits + places, minlength=len(sets) * bits) & 1
    return list(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).reshape(len(sets), PARITY_WORDS))


def set_name(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


_SETS = "id {id}, n long, name binary, parity array<long>, " + ", ".join(f"prefix{k} array<{'long' if k == 0 else 'int'}>" for k in range(ORDERS))


def _set_batch(size: int, percent: int, shared: Broadcast, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    classes = shared.value
    longs = pa.list_(pa.int64())
    for place, data, bounds in W.pieces(batch.column(1)):
        sets = W.shingles(W.find_words(data, bounds, W.PLAIN), size)
        prefixes = [_prefixes(s, classes, percent) if len(s) else [[]] * len(classes) for s in sets]
        arrays = [
            batch.column(0)[place],
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([set_name(s) for s in sets], pa.binary()),
            pa.array(_parity(sets), longs),
            *(pa.array([p[k] for p in prefixes], longs if k == 0 else pa.list_(pa.int32())) for k in range(len(classes))),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "name", "parity", *(f"prefix{k}" for k in range(len(classes)))])


def _block_batch(bits: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Prefix tokens with their nodes, packed by range of token."""
    lists = batch.column(1)
    nodes = np.repeat(batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy()))
    tokens = lists.flatten().to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    tokens, nodes = tokens[order], nodes[order]
    ranges = tokens >> np.uint64(64 - bits)
    cuts = np.flatnonzero(np.diff(ranges)) + 1
    rows = [(int(r[0]), t.tobytes(), n.tobytes()) for r, t, n in zip(*(np.split(a, cuts) for a in (ranges, tokens, nodes)), strict=True) if len(t)]
    if rows:
        kinds = (pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["range", "tokens", "nodes"])


class _Meeting:
    """Entries of one range of tokens; gives those whose token has two nodes or more.

    When many are held, those that have met go out, and one of each token stays
    as a mark, as do entries that have met nothing yet. So what is held is
    bounded by the distinct tokens of the range, however common one of them is.
    """

    def __init__(self):
        self.tokens, self.nodes, self.marks = [], [], []
        self.count, self.kept = 0, 0

    def add(self, tokens: np.ndarray, nodes: np.ndarray) -> None:
        self.tokens.append(tokens)
        self.nodes.append(nodes)
        self.marks.append(np.zeros(len(tokens), bool))
        self.count += len(tokens)

    def met(self) -> tuple[np.ndarray, np.ndarray]:
        tokens, nodes, marks = (np.concatenate(part) for part in (self.tokens, self.nodes, self.marks))
        order = np.argsort(tokens, kind="stable")
        tokens, nodes, marks = tokens[order], nodes[order], marks[order]
        first = np.ones(len(tokens), bool)
        first[1:] = tokens[1:] != tokens[:-1]
        several = np.repeat(np.diff(np.append(np.flatnonzero(first), len(tokens))) > 1, np.diff(np.append(np.flatnonzero(first), len(tokens))))
        out = several & ~marks
        self.tokens, self.nodes, self.marks = [tokens[first]], [nodes[first]], [marks[first] | several[first]]
        self.count = self.kept = int(first.sum())
        return tokens[out], nodes[out]


def _meet_stream(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(meeting: _Meeting) -> Iterator[pa.RecordBatch]:
        tokens, nodes = meeting.met()
        if len(tokens):
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(nodes)], names=["token", "node"])

    now, meeting = None, _Meeting()
    for batch in stream:
        for place, tokens, nodes in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            if place != now and meeting.count:
                yield from rows(meeting)
                meeting = _Meeting()
            now = place
            meeting.add(np.frombuffer(tokens.as_buffer(), np.uint64), np.frombuffer(nodes.as_buffer(), np.int64))
            if meeting.count > 2 * meeting.kept + _HELD:
                yield from rows(meeting)
    if meeting.count:
        yield from rows(meeting)


def _slots(ids: np.ndarray) -> np.ndarray:
    return (W.mix(ids.view(np.uint64)) >> np.uint64(64 - WANTED_BITS)).astype(np.int64)


def _slot_task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks = np.zeros(1 << WANTED_BITS, np.int64)
    for batch in stream:
        marks[_slots(batch.column(0).to_numpy())] = 1
    yield array_rows(marks)


def wanted_slots(hashes: DataFrame) -> np.ndarray:
    """A bitmap, of a fixed size, of the slots that the hashes of wanted ids fall into."""
    marks = sum_arrays(hashes.mapInArrow(_slot_task, "slice int, data binary"), 1 << WANTED_BITS)
    return np.packbits(marks > 0, bitorder="little")


def _token_batch(size: int, shared: Broadcast, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The sets of documents whose id falls into a wanted slot."""
    slots = _slots(batch.column(0).to_numpy())
    batch = batch.filter(pa.array((shared.value[slots >> 3] >> (slots & 7)) & 1 == 1))
    for _, data, bounds in W.pieces(batch.column(1)):
        sets = W.shingles(W.find_words(data, bounds, W.PLAIN), size)
        arrays = [pa.array([set_name(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["name", "tokens"])


def _may_link(percent: int, a: str, b: str) -> Column:
    """Bounds that every linked pair meets: on sizes, and on tokens in one set only."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = (n * percent <= m * 100) & (m * percent <= n * 100)
    # intersection >= (n + m) * p / (100 + p), so at most this many tokens are in one set only.
    most = (n + m) * (100 - percent) / (100 + percent)
    odd = F.aggregate(
        F.zip_with(F.col(f"{a}.parity"), F.col(f"{b}.parity"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, c: total + c
    )
    return sizes & (odd <= most + 1e-6)


class _Join:
    """One run of the join: the tables its steps share."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.docs, self.size, self.percent = docs, size, percent
        kind = docs.schema["id"].dataType.simpleString()
        shared = docs.sparkSession.sparkContext.broadcast(token_classes(docs.select("text"), size))
        sets = docs.mapInArrow(batches(functools.partial(_set_batch, size, percent, shared)), _SETS.format(id=kind))
        # row: a number for each row of the written table.
        self.rows = cut(sets.withColumn("row", F.monotonically_increasing_id()), "sets")
        # Equal sets are one node, that of their first row.
        self.classes = cut(
            self.rows.where("n > 0").groupBy("name").agg(F.min("row").alias("node"), F.min("id").alias("least_id")), "classes"
        )
        #: Sets of the nodes compared so far.
        self.tokens: DataFrame | None = None
        self.nodes = self.rows.join(self.classes.select(F.col("node").alias("row"), "least_id"), "row").withColumnRenamed("row", "node")

    def groups(self) -> DataFrame:
        """(token, node) for tokens in the first prefix of two nodes or more.

        Entries travel packed, by range of token; ranges have about as many."""
        entries = self.rows.agg(F.sum(F.size("prefix0"))).first()[0] or 0
        bits = max(6, math.ceil(math.log2(max(1, entries / _HELD))))
        packed = self.nodes.select("node", "prefix0").mapInArrow(batches(functools.partial(_block_batch, bits)), "range long, tokens binary, nodes binary")
        return packed.repartition("range").sortWithinPartitions("range").mapInArrow(_meet_stream, "token long, node long")

    def filtered(self, pairs: DataFrame, bounds: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) that pass all bounds and share a prefix token under every order."""
        x, y = bounds.alias("x"), bounds.alias("y")
        near = pairs.select("a", "b").distinct().join(x, F.col("a") == F.col("x.node")).join(y, (F.col("b") == F.col("y.node")) & _may_link(self.percent, "x", "y"))
        for k in range(1, ORDERS):
            near = near.where(F.arrays_overlap(f"x.prefix{k}", f"y.prefix{k}"))
        return near.select("a", "b", F.col("x.n").alias("n"), F.col("y.n").alias("m"), F.col("x.id").alias("a_id"), F.col("x.name").alias("a_name"), F.col("y.id").alias("b_id"), F.col("y.name").alias("b_name"))

    def verified(self, candidates: DataFrame) -> DataFrame:
        """The pairs whose sets are similar enough, by comparing the sets.

        Sets are made again from the texts of the documents in the pairs. Those
        are told by a bitmap, so that no text is shuffled; sets of documents
        that share a slot with them are made in vain and dropped by name."""
        candidates = cut(candidates, "pairs")
        ends = [candidates.select(F.col(e).alias("node"), F.col(f"{e}_name").alias("wanted"), F.xxhash64(f"{e}_id").alias("id_hash")) for e in "ab"]
        wanted = ends[0].union(ends[1]).distinct()
        if self.tokens is not None:
            wanted = wanted.join(self.tokens.select("node"), "node", "left_anti")
        wanted = cut(wanted, "wanted")
        shared = self.docs.sparkSession.sparkContext.broadcast(wanted_slots(wanted.select("id_hash")))
        texts = self.docs.select(F.xxhash64("id").alias("id_hash"), "text")
        found = texts.mapInArrow(batches(functools.partial(_token_batch, self.size, shared)), "name binary, tokens array<long>")
        found = found.join(wanted.select("node", "wanted"), F.col("name") == F.col("wanted")).select("node", "tokens")
        found = cut(found.groupBy("node").agg(F.first("tokens").alias("tokens")), "tokens")
        self.tokens = found if self.tokens is None else self.tokens.union(found)
        x, y = self.tokens.alias("x"), self.tokens.alias("y")
        both = candidates.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
        common = F.size(F.array_intersect("x.tokens", "y.tokens"))
        return cut(both.where(common * 100 >= (F.col("n") + F.col("m") - common) * self.percent).select("a", "b"), "links")

    def star_pairs(self, groups: DataFrame) -> DataFrame:
        """Every node of a token with the token's node that has the fewest tokens of its own."""
        centre = groups.groupBy("token").agg(F.min(F.struct("own", "node", "n")).alias("centre"))
        centre = centre.select("token", F.col("centre.node").alias("other"), F.col("centre.n").alias("m"))
        pairs = groups.join(centre, "token").where("node <> other").where(self.sizes("n", "m"))
        return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()

    def sizes(self, n: str, m: str) -> Column:
        return F.expr(f"{n} * {self.percent} <= {m} * 100 and {m} * {self.percent} <= {n} * 100")

    def cross_pairs(self, groups: DataFrame, bounds: DataFrame) -> DataFrame:
        """All pairs of nodes of different components that share a token and meet the bounds.

        Nodes that are still alone meet each other per token, and only pairs
        within the bounds come out of that join. A larger component meets a
        node of another once, whatever number of tokens they share, and its own
        nodes are then held against that node. So a large component costs its
        size for each node that it meets, and never its square."""
        marks = bounds.select("node", "parity")
        alone = groups.where("members = 1").join(marks, "node").select("token", "node", "n", "parity")
        x, y = alone.alias("x"), alone.alias("y")
        small = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & _may_link(self.percent, "x", "y"))
        small = small.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))

        large = groups.where("members > 1").groupBy("token", "component").agg(F.min("n").alias("low"), F.max("n").alias("high"))
        others = groups.select("token", F.col("component").alias("other"), "node", "n", "members")
        fits = F.expr(
            f"component <> other and (members = 1 or component < other) and low * {self.percent} <= n * 100 and n * {self.percent} <= high * 100"
        )
        meetings = large.join(others, "token").where(fits).select("component", "node", "n").distinct().join(marks, "node")
        own = groups.where("members > 1").select("component", "node", "n").distinct().join(marks, "node")
        x, y = own.alias("x"), meetings.alias("y")
        met = x.join(y, (F.col("x.component") == F.col("y.component")) & _may_link(self.percent, "x", "y"))
        pairs = small.union(met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def run(self) -> DataFrame:
        met = cut(self.groups(), "met")
        # own: how many of the node's prefix tokens no other node has there.
        sharing = met.groupBy("node").agg(F.count("*").alias("shared"))
        bounds = self.nodes.join(sharing, "node").withColumn("own", F.size("prefix0") - F.col("shared"))
        bounds = cut(bounds.select("node", "own", "id", "name", "n", "parity", *(f"prefix{k}" for k in range(1, ORDERS))), "bounds")
        groups = cut(met.join(bounds.select("node", "own", "n"), "node"), "groups")
        links = self.verified(self.filtered(self.star_pairs(groups), bounds))
        joined = cut(components(links, "joined"), "joined")
        sizes = joined.groupBy("component").agg(F.count("*").alias("of"))
        found = joined.join(sizes, "component").select("node", F.col("component").alias("found"), "of")
        now = groups.join(found, "node", "left")
        now = now.select("token", "node", "n", F.coalesce("found", "node").alias("component"), F.coalesce("of", F.lit(1)).alias("members"))
        now = cut(now, "groups")
        links = links.union(self.verified(self.filtered(self.cross_pairs(now, bounds), bounds)))
        joined = cut(components(links, "joined"), "joined")
        of_class = self.classes.join(joined, "node", "left").select("name", "least_id", F.coalesce("component", "node").alias("component"))
        of_class = cut(of_class, "components")
        least = of_class.groupBy("component").agg(F.min("least_id").alias("component_id"))
        named = of_class.join(least, "component").select(F.col("name").alias("class"), "component_id", "component")
        out = self.rows.select("row", "id", "n", "name").join(named, F.col("name") == F.col("class"), "left")
        return out.select("row", "id", F.col("n").alias("n_shingles"), "name", F.coalesce("component_id", F.when(F.col("n") == 0, F.col("id"))).alias("component_id"), "component")


def similar_components(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """(row, id, n_shingles, name, component_id, component), a row a document.

    Words are runs without white space, A-Z as small letters; a document's set
    holds its distinct runs of ``size`` words, or with fewer words its whole
    sequence. Two documents link when 100 times the intersection is at least
    ``percent`` times the union. ``component_id`` is the smallest id that links
    reach; null ids come after all others. A null text or one without words has
    an empty set, links with nothing, and is its own component. Repeated rows
    and equal sets are linked. ``name`` names the set, ``component`` the
    component; both are null for empty sets. Only what links reach is told:
    once joined, nodes of a component are not compared with each other, so a
    document's links are not counted.
    """
    return _Join(docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")), size, percent).run()


def shingle_components(docs: DataFrame) -> DataFrame:
    out = similar_components(docs.select("doc_id", "text"), size=3, percent=90)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, null last.

    Documents without words stay. Rows are told by id and text, so an id may be
    null or stand for several texts. Of rows that share the smallest id the one
    whose text has the least hash stays, and of rows that repeat both, one.
    """
    key, hashed = free_name(docs.columns, "_id"), free_name(docs.columns, "_text_hash")
    text_hash = F.xxhash64(text_column(docs, text))
    # Structs compare field by field: rows with an id come first, then its order, then the text's.
    named = docs.select(F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), text_hash.alias("hash")).alias("id"), F.col(text).alias("text"))
    found = similar_components(named, "id", "text", size, percent).where("n_shingles > 0")
    rows = found.groupBy("id").agg(F.count("*").alias("times"), F.min("component_id").alias("component_id"))
    rows = rows.select(F.col("id.id").alias(key), F.col("id.hash").alias(hashed), (F.col("id") == F.col("component_id")).alias("stays"), "times")
    # All rows of a key go, and of a repeated one that stays one row comes back.
    gone = cut(rows.where("times > 1 or not stays"), "gone")
    same = docs[id].eqNullSafe(F.col(key)) & (text_hash == F.col(hashed))
    kept = docs.join(gone.select(key, hashed), same, "left_anti")
    again = docs.join(gone.where("stays").select(key, hashed), same, "left_semi").withColumn(hashed, text_hash)
    return kept.union(again.dropDuplicates([id, hashed]).select(*docs.columns))
