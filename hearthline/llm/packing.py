"""Packing documents into fixed windows of tokens by minimum bin slack.

A document's ids are cut into whole windows and a tail. Only the lengths of
tails decide what goes together: their histogram (fewer entries than a window
has tokens) comes to the driver, where a bitset subset-sum program picks, for
the longest tail left, the multiset of other lengths that fills the window
closest to its capacity, and backtracks how many of each. A pick is repeated as
often as the counts allow. Tails then find their place by their rank among
tails of the same length, which distributed prefix sums give.

Where no multiset fills a window to its capacity, the closest one stays, and its
slack is closed by a piece cut off the beginning of another tail. What is left
of that tail goes back to the histogram under its new length. A tail that is
not longer than the slack would have been picked, so there is always one to cut
until the last window of all, the only one that is padded.
"""

from __future__ import annotations

import base64
import bisect
import functools
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import batches, cut, sums_before

CAPACITY = 1024
END_ID = 0
VOCABULARY = "byte_bpe_50k"
#: Characters of a text that are encoded at once.
SPAN = 1 << 16
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Ids of a text as little-endian 32-bit bytes.

    No token crosses a single space between two words, since the tokenizer's
    pattern lets a word begin with a space but never end with one or hold one.
    So long texts are cut there. Strings of special tokens inside a text are
    ordinary text.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._coder = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _part(self, text: str) -> bytes:
        return self._coder.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def ids(self, text: str) -> bytes:
        parts, start = [], 0
        while len(text) - start > SPAN and (space := _SINGLE_SPACE.search(text, start + SPAN)):
            parts.append(self._part(text[start : space.start()]))
            start = space.start()
        return b"".join([*parts, self._part(text[start:])])


@functools.cache
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


_ENCODED = "id {id}, n_tokens long, n_whole long, tail int, whole_crc array<long>, tail_crc long, kept_from long, kept binary"


def _encode_batch(vocabulary: str, capacity: int, keep_ids: bool, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    coder = encoder(vocabulary)
    end = np.array([END_ID], "<u4").tobytes()
    columns: list[list] = [[] for _ in range(7)]
    for text in batch.column(1):
        ids = coder.ids(text.as_py() or "") + end
        n = len(ids) // 4
        whole = n // capacity
        step = 4 * capacity
        tail = ids[whole * step :]
        kept = ids if keep_ids else tail
        values = (n, whole, n - whole * capacity, [zlib.crc32(ids[k * step : (k + 1) * step]) for k in range(whole)], zlib.crc32(tail), 0 if keep_ids else whole * capacity, _narrow(kept))
        for column, value in zip(columns, values, strict=True):
            column.append(value)
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary())
    arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
    yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_tokens", "n_whole", "tail", "whole_crc", "tail_crc", "kept_from", "kept"])


def _narrow(ids: bytes) -> bytes:
    """Ids as 16-bit numbers if they fit, after a byte that says the width."""
    wide = np.frombuffer(ids, "<u4")
    return b"\2" + wide.astype("<u2").tobytes() if not len(wide) or wide.max() < 1 << 16 else b"\4" + ids


def _widen(kept: bytes) -> bytes:
    return np.frombuffer(kept, "<u2", offset=1).astype("<u4").tobytes() if kept[0] == 2 else kept[1:]


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum is closest to ``room`` from below.

    Bit s of ``reach`` says that s can be made of the lengths so far, the
    longest first. The state before each length is kept, and the counts are
    read back from the last one.
    """
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        steps.append((length, reach))
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            reach |= (reach << (take * length)) & full
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    goal, picked = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        used = 0
        while not before >> goal & 1:
            goal -= length
            used += 1
        if used:
            picked[length] = used
    return picked


#: For each length of tails, and each start of a piece in them: the first ranks of
#: runs of tails, and for each run (first rank, place of the first among its like,
#: length of the piece, first sequence, how many of the like a sequence holds,
#: offset of the first).
Layout = dict[int, dict[int, tuple[list[int], list[tuple[int, ...]]]]]


class _Pool:
    """Tails, and what is left of cut ones, by length; ranks stay in runs."""

    def __init__(self, histogram: dict[int, int]):
        self.counts = {n: c for n, c in histogram.items() if c > 0}
        #: For each length: (length of the tails at first, start of the rest, first rank, how many).
        self.runs = {n: deque([(n, 0, 0, c)]) for n, c in self.counts.items()}
        self.rows: dict[int, dict[int, list[tuple[int, ...]]]] = {n: {} for n in self.counts}

    def take(self, length: int, wanted: int, piece: int, sequence: int, each: int, offset: int) -> None:
        """Place a piece of ``piece`` ids of so many tails, and put the rest back."""
        self.counts[length] -= wanted
        if not self.counts[length]:
            del self.counts[length]
        phase, runs = 0, self.runs[length]
        rest = length - piece
        while phase < wanted:
            origin, start, rank, count = runs.popleft()
            used = min(count, wanted - phase)
            if used < count:
                runs.appendleft((origin, start, rank + used, count - used))
            self.rows[origin].setdefault(start, []).append((rank, phase, piece, sequence, each, offset))
            if rest:
                self.runs.setdefault(rest, deque()).append((origin, start + piece, rank, used))
            phase += used
        if rest:
            self.counts[rest] = self.counts.get(rest, 0) + wanted


def lay_out(histogram: dict[int, int], capacity: int) -> tuple[Layout, int]:
    """Where the tails of each length go, and how many sequences they fill."""
    pool, filled = _Pool(histogram), 0
    while pool.counts:
        longest = max(pool.counts)
        others = pool.counts | {longest: pool.counts[longest] - 1}
        pick = closest_fill(others, capacity - longest)
        pick[longest] = pick.get(longest, 0) + 1
        slack = capacity - sum(n * c for n, c in pick.items())
        need = dict(pick)
        # The length with most tails left is cut, so that a pick is repeated often.
        left = [(c - pick.get(n, 0), n) for n, c in pool.counts.items() if n > slack and c > pick.get(n, 0)]
        cut_off = max(left)[1] if slack and left else None
        if cut_off is not None:
            need[cut_off] = need.get(cut_off, 0) + 1
        times = min(pool.counts[n] // c for n, c in need.items())
        offset = 0
        for n, c in sorted(pick.items(), reverse=True):
            pool.take(n, c * times, n, filled, c, offset)
            offset += n * c
        if cut_off is not None:
            pool.take(cut_off, times, slack, filled, 1, offset)
        filled += times
    layout = {}
    for n, starts in pool.rows.items():
        ordered = {start: sorted(rows) for start, rows in starts.items()}
        layout[n] = {start: ([row[0] for row in rows], rows) for start, rows in ordered.items()}
    return layout, filled


def _tail_places(layout: Layout, base: int, length: int, rank: int) -> list[tuple[int, int, int, int]]:
    """(start in the tail, length, sequence, offset) of each piece of a tail."""
    pieces, start = [], 0
    while start < length:
        firsts, runs = layout[length][start]
        first, phase, piece, sequence, each, offset = runs[bisect.bisect_right(firsts, rank) - 1]
        turn, inside = divmod(rank - first + phase, each)
        pieces.append((start, piece, base + sequence + turn, offset + inside * piece))
        start += piece
    return pieces


_PIECES = "row long, id {id}, start long, length long, ids_crc32 long, n_tokens long, sequence_id long, offset long"
_PIECE_NAMES = ["row", "id", "start", "length", "ids_crc32", "n_tokens", "sequence_id", "offset"]


def _piece_batch(layout: Layout, capacity: int, base: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The pieces of each document; parts of a tail that is cut have no checksum yet."""
    names = ("n_tokens", "n_whole", "tail", "whole_crc", "tail_crc", "first_whole", "rank")
    rows: list[tuple] = []
    for k, (n, whole, tail, crcs, tail_crc, first, rank) in enumerate(zip(*(batch.column(c).to_pylist() for c in names), strict=True)):
        rows += [(k, j * capacity, capacity, crcs[j], n, first + j, 0) for j in range(whole)]
        if tail:
            parts = _tail_places(layout, base, tail, rank)
            crc = tail_crc if len(parts) == 1 else None
            rows += [(k, whole * capacity + start, length, crc, n, sequence, offset) for start, length, sequence, offset in parts]
    owner, *columns = zip(*rows, strict=True)
    owner = pa.array(owner)
    arrays = [batch.column("row").take(owner), batch.column("id").take(owner), *(pa.array(c, pa.int64()) for c in columns)]
    yield pa.RecordBatch.from_arrays(arrays, names=_PIECE_NAMES)


def _id_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces with their ids and the ids' checksum."""
    ids = []
    for start, length, kept_from, kept in zip(*(batch.column(c).to_pylist() for c in ("start", "length", "kept_from", "kept")), strict=True):
        ids.append(_widen(kept)[4 * (start - kept_from) : 4 * (start - kept_from + length)])
    arrays = [pa.array(map(zlib.crc32, ids), pa.int64()) if n == "ids_crc32" else batch.column(n) for n in _PIECE_NAMES]
    yield pa.RecordBatch.from_arrays([*arrays, pa.array(ids, pa.binary())], names=[*_PIECE_NAMES, "ids"])


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, n_tokens, sequence_id, offset), a row a piece.

    A document is its ids followed by one end id; null text is empty text, so
    it is the end id alone. Every row of ``docs`` is a document, also repeated
    rows and rows with a null id. ``ids_crc32`` is over the piece's ids as
    little-endian 32-bit numbers; ``keep_ids`` adds them as ``ids``. Sequences
    are numbered from 0 without gaps and only the last can be shorter than
    ``capacity``.
    """
    kind = docs.schema[id].dataType.simpleString()
    narrow = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    encoded = narrow.mapInArrow(batches(functools.partial(_encode_batch, vocabulary, capacity, keep_ids)), _ENCODED.format(id=kind))
    key = F.md5(F.concat_ws(":", F.col("id").cast("string"), "n_tokens", "tail_crc"))
    # Texts are encoded once, and what follows moves narrow rows only.
    encoded = cut(encoded.withColumns({"key": key, "one": F.lit(1), "all": F.lit(0), "row": F.monotonically_increasing_id()}), "encoded")
    total = encoded.agg(F.coalesce(F.sum("n_whole"), F.lit(0))).first()[0]
    layout, _ = lay_out({row["tail"]: row["count"] for row in encoded.where("tail > 0").groupBy("tail").count().collect()}, capacity)
    ranked = sums_before(encoded.drop("kept", "kept_from"), ["tail"], "key", ["row"], "one", "rank")
    ranked = sums_before(ranked, ["all"], "key", ["row"], "n_whole", "first_whole")
    pieces = cut(ranked.mapInArrow(batches(functools.partial(_piece_batch, layout, capacity, total)), _PIECES.format(id=kind)), "pieces")
    lacking = pieces if keep_ids else pieces.where(F.col("ids_crc32").isNull())
    filled = lacking.join(encoded.select("row", "kept_from", "kept"), "row").mapInArrow(batches(_id_batch), _PIECES.format(id=kind) + ", ids binary")
    if keep_ids:
        return filled.drop("row")
    return pieces.where(F.col("ids_crc32").isNotNull()).union(filled.drop("ids")).drop("row")


def packed_pieces(docs: DataFrame) -> DataFrame:
    out = pack(docs)
    return out.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", F.col("n_tokens").alias("doc_tokens"), "sequence_id", "offset")
