from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hearthline.llm import packing
from hearthline.llm.common import table


def ids_of(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder.encode_special_tokens = True
    return [[*e.ids, packing.END_ID] for e in coder.encode_batch_fast(texts, add_special_tokens=False)]


def check(rows, docs, capacity):
    """Every id in one piece, pieces end to end in sequences, little padding."""
    expected = defaultdict(list)
    for (doc_id, text), ids in zip(docs, ids_of([t or "" for _, t in docs]), strict=True):
        expected[doc_id].append(ids)
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(expected)
    for doc_id, pieces in by_doc.items():
        if len(expected[doc_id]) > 1:
            assert sum(p["length"] for p in pieces) == sum(map(len, expected[doc_id]))
            continue
        (ids,), place = expected[doc_id], 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == place and p["n_tokens"] == len(ids)
            place += p["length"]
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[p["start"] : place], "<u4").tobytes())
        assert place == len(ids)
    short = 0
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place and length > 0
            place += length
        assert place <= capacity
        short += place < capacity
    assert short <= 1
    assert sorted(sequences) == list(range(len(sequences)))


@pytest.mark.parametrize("capacity", [16, 64, 1024])
def test_all_ids_once(spark, small, capacity):
    docs = table(spark, small, "documents")
    rows = packing.pack(docs, capacity=capacity).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], capacity)


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (None, "no id"), (3, "same"), (3, "same"), (4, "a  b\n c \t d\r\n   x　y "), (5, "word " * 5000), (6, "<|endoftext|> it's")]
    frame = spark.createDataFrame([(i, t, "x", 7) for i, t in docs], "doc_id long, text string, other string, start long")
    rows = packing.pack(frame, capacity=32).collect()
    check(rows, docs, 32)
    with_ids = packing.pack(frame, capacity=32, keep_ids=True).collect()
    check(with_ids, docs, 32)
    joined = b"".join(bytes(r["ids"]) for r in sorted((r for r in with_ids if r["id"] == 5), key=lambda r: r["start"]))
    assert np.frombuffer(joined, "<u4").tolist() == ids_of([docs[6][1]])[0]


def test_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_one_length_only(spark):
    """A third of all documents, or all, may have one length that fills no window."""
    docs = [(i, "word " * 21 + "end") for i in range(100)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), capacity=32).collect()
    check(rows, docs, 32)


def test_every_window_is_a_closest_pick():
    """All tails are laid out by picks; only the last sequence is short, and nothing is streamed."""
    random.seed(6)
    for capacity in (8, 33, 128):
        for _ in range(60):
            histogram = {random.randint(1, capacity - 1): random.randint(1, 40) for _ in range(random.randint(0, 9))}
            layout, filled = packing.lay_out(histogram, capacity)
            taken = defaultdict(list)
            for length, count in histogram.items():
                for rank in range(count):
                    place = 0
                    for start, piece, sequence, offset in packing._tail_places(layout, 0, length, rank):
                        assert start == place and piece > 0
                        place += piece
                        taken[sequence].append((offset, piece))
                    assert place == length
            total = sum(n * c for n, c in histogram.items())
            assert sorted(taken) == list(range(filled)) and filled == -(-total // capacity)
            for parts in taken.values():
                ends = np.cumsum([piece for _, piece in sorted(parts)])
                assert [offset for offset, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= capacity


def test_closest_fill_is_best():
    random.seed(5)
    for _ in range(300):
        counts = {random.randint(1, 30): random.randint(1, 4) for _ in range(random.randint(0, 6))}
        room = random.randint(0, 60)
        sums = {0}
        for length, count in counts.items():
            sums = {s + k * length for s in sums for k in range(count + 1) if s + k * length <= room}
        pick = packing.closest_fill(counts, room)
        assert sum(n * c for n, c in pick.items()) == max(sums)
        assert all(c <= counts[n] for n, c in pick.items())
