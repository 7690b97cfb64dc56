"""Packing: differencing against all assignments of small cases, every id in one piece."""

import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surgecast.llm import packing, queries


def plain_difference(sizes, k):
    """The textbook form: full tuples of sums and sets, merged in opposing order."""
    parts = [(s, i, [(s if j == 0 else 0, [i] if j == 0 else []) for j in range(k)]) for i, s in enumerate(sizes)]
    serial = len(sizes)
    while len(parts) > 1:
        parts.sort(key=lambda p: (-p[0], p[1]))
        (_, _, a), (_, _, b) = parts.pop(0), parts.pop(0)
        both = sorted(((x + y, u + v) for (x, u), (y, v) in zip(a, b[::-1])), key=lambda w: -w[0])
        parts.append((both[0][0] - both[-1][0], serial, both))
        serial += 1
    return sorted(s for s, _ in parts[0][2])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=25), st.integers(1, 8))
def test_differencing_equals_the_plain_form(sizes, k):
    window = packing.difference(np.array(sizes), k)
    assert sorted(np.bincount(window, sizes, k).astype(int).tolist()) == plain_difference(sizes, k)


def test_differencing_is_close_to_the_best():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes = rng.integers(1, 60, 8)
        best = min(max(np.bincount(w, sizes, 3)) for w in itertools.product(range(3), repeat=8))
        assert np.bincount(packing.difference(sizes, 3), sizes, 3).max() <= 1.35 * best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60), st.sampled_from([64, 100]))
def test_windows_and_filling(sizes, capacity):
    sizes = np.array(sizes, np.int64)
    if not len(sizes):
        return
    window = packing.near_equal(sizes, capacity)
    assert np.bincount(window, sizes).max() <= capacity
    seen = np.zeros(sizes.sum(), int)
    begin = np.cumsum(sizes) - sizes
    lengths = []
    for pieces in packing.fill(sizes, window, capacity):
        lengths.append(sum(n for _, _, n in pieces))
        for i, start, n in pieces:
            assert n > 0 and start + n <= sizes[i]
            seen[begin[i] + start : begin[i] + start + n] += 1
    assert (seen == 1).all()
    short = [n for n in lengths if n != capacity]
    assert all(n & (n - 1) == 0 and n < capacity for n in short) and len(set(short)) == len(short)


def test_window_count_rises():
    sizes = np.full(9, 2100)
    assert sorted(np.bincount(packing.near_equal(sizes, 4096)).tolist()) == [1] * 9


@pytest.mark.parametrize("cut", [True, False])
def test_pieces_hold_every_id_once(spark, cut):
    path = queries.tokenizer_path(queries.WORD_BPE)
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(path)
    rng = np.random.default_rng(7)
    texts = [" ".join(rng.choice(["the", "Thé", "x9", "cat,"], rng.integers(0, 60)).tolist()) for _ in range(300)] + [None, "", "many words " * 3000]
    rows = [(None if i == 5 else i // 2 if i < 20 else i, t, "x", 3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, start int").repartition(3)
    got = packing.pack(df, path, 2, capacity=128, shard_ids=4000, cut=cut).collect()
    by_sequence, by_doc = {}, {}
    for r in got:
        assert r.length == len(r.ids) // 4 > 0
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.doc_tokens, r.start, bytes(r.ids)))
    lengths = []
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 128
        lengths.append(at)
    want = {}
    for d, t, _, _ in rows:
        want.setdefault(d, []).append(np.array(tool.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
    for d, texts_ids in want.items():
        if len(texts_ids) == 1:
            assert b"".join(x[2] for x in sorted(by_doc[d])) == texts_ids[0]
        assert sum(len(x[2]) for x in by_doc[d]) == sum(map(len, texts_ids))
    if cut:
        assert all(n & (n - 1) == 0 for n in lengths)
    else:
        assert sum(lengths) > 0.9 * 128 * len(lengths)


def test_empty_table_and_no_end_id(spark):
    path = queries.tokenizer_path(queries.WORD_BPE)
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "the")], "doc_id string, text string")
    assert packing.pack(df.limit(0), path, 2).count() == 0
    got = packing.pack(df, path, None).withColumn("crc", F.crc32("ids")).collect()
    assert [(r.doc_id, r.start, r.length, r.doc_tokens, r.offset) for r in got] == [("c", 0, 1, 1, 0)]
    assert got[0].crc == zlib.crc32(got[0].ids)
