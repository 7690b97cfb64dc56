"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Each task packs its documents a shard of about a million tokens at a time.
Whole windows at a long document's beginning are sequences of their own; what
remains are the items. Each item begins as a partition of itself and k - 1
empty windows. The two partitions of the widest spread are merged, the fullest
windows of the one with the emptiest of the other, until one is left: k windows
of near-equal length. If one is over the capacity, k rises and the shard is
partitioned again.

Documents may be cut, and a sequence whose length is a power of two needs no
padding. So the fullest windows are then filled up from the emptiest ones, and
the tokens left over (fewer than the capacity) make sequences of powers of two:
nothing is padded, and a filled window holds two cut documents at most.

No rows are shuffled. A shard's sequences depend on its task's rows alone, so a
task that runs again after a loss makes the same ones.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgecast.llm import words
from surgecast.llm.word_tokens import tool_of
from surgecast.session import ship_package

CAPACITY = 4096
SHARD_IDS = 1 << 20
#: Sequence ids: the task's number in the upper bits.
TASK_BITS = 40
#: Bytes of ids in a batch that goes back to Spark.
OUT_BYTES = 1 << 21


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window (0 to k - 1) of each item, by multiway differencing."""
    n = len(sizes)
    # a partial partition: lengths of its windows, falling, and the node in each; empty windows aren't listed
    agenda = [(-int(s), i, np.array([s], np.int64), np.array([i], np.int64)) for i, s in enumerate(sizes.tolist())]
    heapq.heapify(agenda)
    left, right = [], []  # the two nodes joined in node n + i
    serial = n
    while len(agenda) > 1:
        _, _, a, at = heapq.heappop(agenda)
        _, _, b, bt = heapq.heappop(agenda)
        both = len(a) + len(b) - k  # windows that get something from both
        if both <= 0:
            lengths, nodes = np.concatenate([a, b]), np.concatenate([at, bt])
        else:
            own = len(a) - both
            lengths = np.concatenate([a[:own], a[own:] + b[::-1][:both], b[: len(b) - both]])
            new = np.arange(len(left), len(left) + both) + n
            left.extend(at[own:].tolist())
            right.extend(bt[::-1][:both].tolist())
            nodes = np.concatenate([at[:own], new, bt[: len(b) - both]])
        order = np.argsort(-lengths, kind="stable")
        lengths, nodes = lengths[order], nodes[order]
        spread = int(lengths[0]) - (int(lengths[-1]) if len(lengths) == k else 0)
        heapq.heappush(agenda, (-spread, serial, lengths, nodes))
        serial += 1
    window = np.zeros(n + len(left), np.int64)
    if agenda:
        window[agenda[0][3]] = np.arange(len(agenda[0][3]))
    for i in range(len(left) - 1, -1, -1):
        window[left[i]] = window[right[i]] = window[n + i]
    return window[:n]


def near_equal(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item: as few near-equal windows as differencing finds
    without one over the capacity. No item may be larger than that."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = difference(sizes, k)
        over = np.bincount(window, sizes, k) - capacity
        if over.max(initial=0) <= 0:
            return window
        k += max(1, int(over[over > 0].sum()) // capacity)


def fill(sizes: np.ndarray, window: np.ndarray, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (item, start, length) without padding: full ones, then
    powers of two, made from windows within the capacity."""
    n = int(window.max()) + 1 if len(window) else 0
    load = np.bincount(window, sizes, n).astype(np.int64)
    rank = np.argsort(-load, kind="stable")
    items: list[list[int]] = [[] for _ in range(n)]
    for i, w in enumerate(window.tolist()):
        items[w].append(i)
    full, rest = divmod(int(sizes.sum()), capacity)
    spare = [[i, 0, int(sizes[i])] for w in rank[full:].tolist() for i in items[w]][::-1]

    def take(room: int) -> Iterator[tuple[int, int, int]]:
        while room:
            i, start, length = spare[-1]
            n = min(room, length)
            yield i, start, n
            room -= n
            if n == length:
                spare.pop()
            else:
                spare[-1] = [i, start + n, length - n]

    out = []
    for w in rank[:full].tolist():
        own = [(i, 0, int(sizes[i])) for i in items[w]]
        out.append(own + list(take(capacity - int(load[w]))))
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            out.append(list(take(1 << bit)))
    return out


class Shard:
    """Documents' ids of one task until there are enough to pack."""

    def __init__(self, capacity: int, first: int, cut: bool):
        self.capacity, self.next, self.cut = capacity, first, cut
        self.docs: list[tuple[object, int, int, np.ndarray]] = []
        self.held = 0

    def add(self, doc_id: object, ids: np.ndarray) -> Iterator[tuple]:
        """Full windows at the document's beginning go out at once."""
        whole = len(ids) // self.capacity * self.capacity
        for at in range(0, whole, self.capacity):
            yield doc_id, at, ids[at : at + self.capacity], len(ids), self.next, 0
            self.next += 1
        if whole < len(ids):
            self.docs.append((doc_id, whole, len(ids), ids[whole:]))
            self.held += len(ids) - whole

    def close(self) -> Iterator[tuple]:
        """Rows (doc_id, start, ids, doc_tokens, sequence_id, offset) of all items."""
        sizes = np.array([len(d[3]) for d in self.docs], np.int64)
        if len(sizes):
            window = near_equal(sizes, self.capacity)
            if self.cut:
                sequences = fill(sizes, window, self.capacity)
            else:
                sequences = [[(i, 0, int(sizes[i])) for i in np.flatnonzero(window == w).tolist()] for w in range(int(window.max()) + 1)]
            for pieces in sequences:
                offset = 0
                for i, start, n in pieces:
                    doc_id, whole, total, ids = self.docs[i]
                    yield doc_id, whole + start, ids[start : start + n], total, self.next, offset
                    offset += n
                self.next += 1
        self.docs, self.held = [], 0


def pack(docs: DataFrame, tokenizer: str, end_id: int | None, capacity: int = CAPACITY, shard_ids: int = SHARD_IDS, cut: bool = True) -> DataFrame:
    """Pack the token ids of whole texts into sequences of at most ``capacity``.

    Returns one row a piece: doc_id, start (its document's ids before it),
    length, ids (binary, little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset in its sequence. With ``cut`` all sequences but a few
    of powers of two are full; without it only documents over the capacity are
    cut, and windows are near-equal.

    ``docs`` has doc_id and text; other columns aren't read. Null and empty
    texts have the end id only (no row, if there's none). Rows are packed one
    by one: repeated and null doc_ids are documents of their own. An empty
    table gives no rows.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    ship_package(docs.sparkSession)
    tail = np.array([] if end_id is None else [end_id], np.uint32)
    doc_id = docs.schema["doc_id"].dataType
    long = T.LongType()
    out = T.StructType([T.StructField("doc_id", doc_id), T.StructField("start", long), T.StructField("length", long), T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", long), T.StructField("sequence_id", long), T.StructField("offset", long)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = tool_of(tokenizer)
        shard = Shard(capacity, TaskContext.get().partitionId() << TASK_BITS, cut)
        rows: list[tuple] = []
        size, kind = 0, pa.int64()

        def batch() -> pa.RecordBatch:
            d, start, ids, total, sequence, offset = zip(*rows)
            cols = [pa.array(d, kind), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
            return pa.RecordBatch.from_arrays([*cols, *(pa.array(x, pa.int64()) for x in (total, sequence, offset))], names=out.names)

        def found(doc_ids: list, ids: np.ndarray, at: list[int]) -> Iterator[tuple]:
            for d, x, y in zip(doc_ids, at[:-1], at[1:]):
                yield from shard.add(d, np.concatenate([ids[x:y], tail]))
                if shard.held >= shard_ids:
                    yield from shard.close()

        for b in batches:
            kind = b.schema.field(0).type
            _, off = words.utf8(b.column(1))
            for a, z in words.chunks(off):
                ids, at = tool.batch(b.column(1).slice(a, z - a))
                for row in found(b.column(0).slice(a, z - a).to_pylist(), ids, at.tolist()):
                    rows.append(row)
                    size += row[2].nbytes + 64
                    if size > OUT_BYTES:
                        yield batch()
                        rows, size = [], 0
        for row in shard.close():
            rows.append(row)
            size += row[2].nbytes + 64
            if size > OUT_BYTES:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()
        words.release()

    return docs.select(F.col("doc_id"), F.col("text").cast("string")).mapInArrow(run, out)
