"""Periodic runs of words, found in a grammar of the text.

The word numbers of some texts are compressed by Re-Pair: frequent pairs of
neighbours become nonterminals, round after round. Rounds work on all pairs at
once: a pair is replaced where it is more frequent than the pairs it overlaps.
What is left of a text is folded into a balanced tree, so that every text has
one root.

A run that lies in a text lies in some smallest node of the derivation, and
crosses the boundary between that node's two parts. So each nonterminal is
searched once, at one of its places, for runs that cross its boundary; what is
found is moved to all places where the nonterminal was made, and intervals that
lie inside another one of the same period are dropped.

Across a boundary a run of period q, four periods long, has two whole periods
on one side. Equal words at a distance of q from the boundary, then equal
hashes of two neighbouring stretches of q words, leave few candidates; their
ends are found by bisection on prefix hashes of 62 bits.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import batches, free_name
from hearthline.llm.words import mix

#: A run has this many words, and this many periods, at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words of the texts that are compressed together; a longer text is alone.
PIECE_WORDS = 1 << 17
#: Candidates (boundary, period) looked at in one step.
STEP = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Moduli and bases of the hashes.
_PRIMES = ((2**31 - 1, 1_103_515_245), (2**31 - 19, 747_796_405))


@dataclass
class Grammar:
    """Nodes as one place each, and all places where each was made."""

    #: Where one occurrence of a node begins, where its second part begins, and where it ends.
    start: np.ndarray
    middle: np.ndarray
    end: np.ndarray
    #: Node and beginning of every occurrence.
    node: np.ndarray
    place: np.ndarray


def _ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each size n the numbers 0 to n - 1, and whose they are."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _chosen(symbols: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose pair is replaced in this round, a number for each distinct
    pair, and the places where a pair occurs twice or more.

    Among equal pairs that overlap every other one counts. A place is taken
    when its pair is more frequent, by powers of two, than both pairs it
    overlaps; a hash of the pair decides between others, so that equal
    stretches are cut alike.
    """
    places = np.flatnonzero(live)
    codes = (symbols[places].astype(np.uint64) << np.uint64(32)) | symbols[places + 1].astype(np.uint64)
    order = np.argsort(codes, kind="stable")
    group = np.zeros(len(codes), np.int64)
    group[1:] = np.cumsum(codes[order][1:] != codes[order][:-1])
    count = np.empty(len(codes), np.int64)
    count[order] = np.bincount(group)[group] if len(group) else group
    twice = count >= 2
    places, codes, count = places[twice], codes[twice], count[twice]
    # Every other place of a chain of overlapping equal pairs.
    near = places[1:] == places[:-1] + 1
    linked = np.zeros(len(places), bool)
    linked[1:] = near & (codes[1:] == codes[:-1])
    chain = np.maximum.accumulate(np.where(linked, 0, np.arange(len(places))))
    odd = (np.arange(len(places)) - chain) % 2 == 1
    # Bits of frequency before 48 bits of hash.
    weight = (np.log2(count).astype(np.uint64) << np.uint64(48)) | (mix(codes * _ODD) >> np.uint64(16))
    weight[odd] = 0
    taken = ~odd
    taken[1:] &= ~near | (weight[1:] > weight[:-1])
    taken[:-1] &= ~near | (weight[:-1] > weight[1:])
    return places[taken], codes[taken], places


def re_pair(words: np.ndarray, text: np.ndarray) -> Grammar:
    """The grammar of word numbers; ``text`` numbers the text of each word, rising."""
    symbols, places = words.astype(np.int64), np.arange(len(words))
    ends = places + 1
    none = np.zeros(0, np.int64)
    starts_of, middles_of, ends_of, nodes, made = ([none] for _ in range(5))
    count, symbol = 0, int(words.max()) + 1 if len(words) else 0

    def inside() -> np.ndarray:
        """Pairs of neighbours in one text."""
        return text[:-1] == text[1:]

    def replace(at: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Pairs at these places become nodes, equal numbers one node; which symbols are new."""
        nonlocal symbols, places, ends, text, count, symbol
        kinds, one, node = np.unique(number, return_index=True, return_inverse=True)
        starts_of.append(places[at[one]])
        middles_of.append(places[at[one] + 1])
        ends_of.append(ends[at[one] + 1])
        nodes.append(node + count)
        made.append(places[at])
        symbols[at] = node + symbol
        ends[at] = ends[at + 1]
        fresh = np.zeros(len(symbols), bool)
        fresh[at] = True
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        count, symbol = count + len(kinds), symbol + len(kinds)
        symbols, places, ends, text, fresh = (part[keep] for part in (symbols, places, ends, text, fresh))
        return fresh

    live = inside()
    while live.any():
        at, pair, twice = _chosen(symbols, live)
        if not len(at):
            break
        # A pair that was rare stays so unless one of its parts is new.
        again = np.zeros(len(symbols), bool)
        again[twice] = True
        kept = np.ones(len(symbols), bool)
        kept[at + 1] = False
        fresh = replace(at, pair)
        live = (again[kept][:-1] | fresh[:-1] | fresh[1:]) & inside()
    while inside().any():
        # Neighbours two by two, counted from the beginning of each text.
        even = (np.arange(len(text)) - np.searchsorted(text, text)) % 2 == 0
        at = np.flatnonzero(even[:-1] & inside())
        replace(at, np.arange(len(at)))
    return Grammar(*(np.concatenate(part) for part in (starts_of, middles_of, ends_of, nodes, made)))


class _Hashes:
    """Hashes of stretches of words modulo two primes, and how far two places agree."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = words
        self.parts = []
        for prime, base in _PRIMES:
            powers = np.ones(1, np.int64)
            while len(powers) <= n:
                powers = np.concatenate([powers, powers * pow(base, len(powers), prime) % prime])
            values = (mix((words.astype(np.uint64) + np.uint64(1)) * _ODD) % np.uint64(prime)).astype(np.int64)
            sums = np.zeros(n + 1, np.int64)
            np.cumsum(values * powers[:n] % prime, out=sums[1:])
            self.parts.append((prime, powers, sums % prime))

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the words from a and from b, a before b, agree over a length."""
        same = np.ones(len(a), bool)
        for prime, powers, sums in self.parts:
            one = (sums[a + length] - sums[a]) % prime * powers[b - a] % prime
            same &= one == (sums[b + length] - sums[b]) % prime
        return same

    def _reach(self, most: np.ndarray, agree) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            good = agree(middle)
            low = np.where(open_ & good, middle, low)
            high = np.where(open_ & ~good, middle - 1, high)
        return low

    def forward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        return self._reach(most, lambda n: self.equal(a, b, n))

    def backward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        return self._reach(most, lambda n: self.equal(a - n, b - n, n))


def _squares(hashes: _Hashes, boundary: np.ndarray, room: np.ndarray, ahead: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(node, q): two equal stretches of q words follow (or precede) the boundary."""
    words = hashes.words
    cuts = np.searchsorted(np.cumsum(room), np.arange(STEP, int(room.sum()) + STEP, STEP))
    for low, high in itertools.pairwise([0, *np.unique(np.minimum(cuts + 1, len(room))).tolist()]):
        owner, q = _ragged(room[low:high])
        q += 1
        b = boundary[low:high][owner]
        alike = words[b] == words[b + q] if ahead else words[b - 1] == words[b - 1 - q]
        owner, q, b = owner[alike], q[alike], b[alike]
        a = b if ahead else b - 2 * q
        square = hashes.equal(a, a + q, q)
        yield owner[square] + low, q[square]


def crossing_runs(words: np.ndarray, grammar: Grammar) -> tuple[np.ndarray, ...]:
    """(node, period, start, end) of the runs across each node's boundary, inside the node's place."""
    hashes = _Hashes(words)
    start, middle, end = grammar.start, grammar.middle, grammar.end
    length = end - start
    widest = np.where(length >= LEAST_WORDS, length // LEAST_PERIODS, 0)
    found = []
    for ahead in (True, False):
        side = end - middle if ahead else middle - start
        for node, q in _squares(hashes, middle, np.minimum(widest, side // 2), ahead):
            low, high, at = start[node], end[node], middle[node]
            # From the square on: how far words agree with those q further.
            pivot = at if ahead else at - 2 * q
            first = pivot - hashes.backward(pivot, pivot + q, pivot - low)
            last = pivot + q + hashes.forward(pivot, pivot + q, high - q - pivot)
            good = (last - first >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)) & (first < at) & (last > at)
            found.append(np.stack([node, q, first, last])[:, good])
    every = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
    node, q, first, last = np.unique(every, axis=1)
    keep = _smallest(node, q, first, last)
    return node[keep], q[keep], first[keep], last[keep]


def _smallest(group: np.ndarray, q: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Without intervals that lie inside one of the same group whose period divides theirs."""
    order = np.lexsort((q, group))
    kept: list[int] = []
    chosen: list[int] = []
    current = None
    for k, g, p, f, t in zip(order.tolist(), group[order].tolist(), q[order].tolist(), first[order].tolist(), last[order].tolist(), strict=True):
        if g != current:
            current, chosen = g, []
        if not any(p % q[c] == 0 and first[c] <= f and t <= last[c] for c in chosen):
            chosen.append(k)
            kept.append(k)
    return np.array(kept, np.int64)


def find_runs(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of the texts, by start, then period.

    ``words`` are numbers of words, ``text`` the rising number of each one's text.
    """
    grammar = re_pair(words, text)
    node, q, first, last = crossing_runs(words, grammar)
    # All places where the nodes with runs were made.
    order = np.argsort(grammar.node, kind="stable")
    made = grammar.node[order]
    low, high = np.searchsorted(made, node), np.searchsorted(made, node, "right")
    owner, step = _ragged(high - low)
    shift = grammar.place[order][low[owner] + step] - grammar.start[node[owner]]
    q, first, last = q[owner], first[owner] + shift, last[owner] + shift
    # Intervals of a period that do not lie inside another one, longest first at each start.
    order = np.lexsort((-last, first, q))
    q, first, last = q[order], first[order], last[order]
    # Periods are told apart in one running maximum by a step that is wider than all words.
    wide = q * (len(words) + 1)
    reach = np.maximum.accumulate(wide + last) if len(q) else q
    whole = np.ones(len(q), bool)
    whole[1:] = wide[1:] + last[1:] > reach[:-1]
    q, first, last = q[whole], first[whole], last[whole]
    order = np.lexsort((q, first))
    return first[order], (last - first)[order], q[order]


def _repeated(count: int, turn: int | None) -> np.ndarray:
    """Numbers of the words of a text whose end is made periodic; see ``repeated_ends``."""
    places = np.arange(count)
    if turn is None or turn % 10 or not count:
        return places
    g = turn // 10
    a = g % count
    p = 1 + (count - a) // (3 + g % 8)
    return np.where(places < a, places, a + (places - a) % p)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _pieces(texts: pa.Array, turns: list[int | None]) -> Iterator[list[list[bytes]]]:
    """Texts as words, about PIECE_WORDS at a time."""
    piece, size = [], 0
    for text, turn in zip(texts, turns, strict=True):
        # bytes.split cuts at the six white ASCII characters.
        words = (text.as_py() or "").encode().split()
        if turn is not None and turn % 10 == 0:
            words = [words[k] for k in _repeated(len(words), turn).tolist()]
        if piece and size + len(words) > PIECE_WORDS:
            yield piece
            piece, size = [], 0
        piece.append(words)
        size += len(words)
    if piece:
        yield piece


def _piece_rows(piece: list[list[bytes]]) -> Iterator[tuple[int, list[dict[str, int]], bytes]]:
    numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    sizes = np.array([len(words) for words in piece])
    total = int(sizes.sum())
    flat = np.fromiter(map(numbers.__getitem__, itertools.chain.from_iterable(piece)), np.int64, total)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    start, length, period = find_runs(flat, np.repeat(np.arange(len(piece)), sizes))
    dropped = np.zeros(total + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    kept = np.cumsum(dropped)[:total] == 0
    low, high = np.searchsorted(start, bounds[:-1]), np.searchsorted(start, bounds[1:])
    for k, words in enumerate(piece):
        base = int(bounds[k])
        runs = [
            {"start": s - base, "length": n, "period": p}
            for s, n, p in zip(*(part[low[k] : high[k]].tolist() for part in (start, length, period)), strict=True)
        ]
        left = itertools.compress(words, kept[base : base + len(words)].tolist()) if runs else words
        yield len(words), runs, b" ".join(left)


def _batch_runs(kept: list[str], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    done = 0
    for piece in _pieces(batch.column("text"), batch.column("turn").to_pylist()):
        counts, runs, texts = zip(*_piece_rows(piece), strict=True)
        columns = [pa.array(counts, pa.int64()), pa.array(runs, _RUNS), pa.array([t.decode() for t in texts], pa.string())]
        same = [batch.column(c).slice(done, len(piece)) for c in kept]
        yield pa.RecordBatch.from_arrays([*same, *columns], names=[*kept, "n_words", "runs", "collapsed"])
        done += len(piece)


def text_runs(documents: DataFrame, id: str = "doc_id", text: str = "text", turn: Column | None = None) -> DataFrame:
    """Each row's id with n_words, its runs (start, length, period) and the collapsed text.

    Words lie between white ASCII characters. A run is a stretch with smallest
    period q, of max(LEAST_WORDS, LEAST_PERIODS * q) words or more, that no
    neighbouring word extends; runs come by start, then period. In the
    collapsed text the words that a run contains after its first q words are
    gone, and single spaces stand between the others. Null and empty texts have
    no words, no runs and an empty collapsed text. Every row is worked on by
    itself: repeated rows and null ids come back as they are, other columns do
    not. Texts never leave their task.

    ``turn`` is a whole number t of each row: where t % 10 is 0 the end of the
    text is made periodic first. With g = t // 10 and n words, word i from
    a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    A null leaves the text alone.
    """
    turn = F.lit(None) if turn is None else turn
    name = free_name(["text", "turn", "n_words", "runs", "collapsed"], id)
    rows = documents.select(F.col(id).alias(name), F.col(text).cast("string").alias("text"), turn.cast("long").alias("turn"))
    kind = documents.schema[id].dataType.simpleString()
    shape = f"`{name}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(batches(lambda batch: _batch_runs([name], batch)), shape).withColumnRenamed(name, id)


def run_digests(documents: DataFrame) -> DataFrame:
    """The query: number of runs, the longest one, and digests of runs and collapsed text.

    Documents with crc32(doc_id as text) % 10 = 0 are made periodic first; one
    without an id is left alone.
    """
    found = text_runs(documents, turn=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    # Longest first, then smallest start, then smallest period.
    ranked = F.transform(
        "runs", lambda r: F.struct((-r["length"]).alias("negative"), r["start"].alias("start"), r["period"].alias("period"))
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    best = F.col("_best")
    length = -best["negative"]
    return found.withColumn("_best", F.array_min(ranked)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        length.alias("length"),
        best["period"].alias("period"),
        F.floor(length * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
