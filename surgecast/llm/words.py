"""Vectorised word and n-gram hashing over Arrow string batches.

Used inside tasks only: the bytes of a few hundred texts are handled as one
numpy array, so no Python runs per word. Hashes are 64-bit and depend on
nothing but the words, hence are equal on every executor and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; bounds the temporary arrays.
CHUNK_BYTES = 1 << 20
#: Bytes of text hashed into shingles at a time: each takes a few 8-byte numbers.
HASH_BYTES = 1 << 18
MULT = np.uint64(0x9E3779B97F4A7C15)
NGRAM = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on uint64 (xor-shift and odd multipliers)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * MULT)


def release() -> None:
    """Give freed memory back to the system; a reused worker else keeps its peak."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def frugal(run):
    """``run`` (batches to batches) with freed memory given back before each further batch and after the last."""

    def sparing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, b in enumerate(batches):
            if i:
                release()
            yield b

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(sparing(batches))
        release()

    return wrapped


def _class(ranges: list[tuple[int, int]]) -> np.ndarray:
    out = np.ones(256, dtype=bool)
    for a, b in ranges:
        out[a : b + 1] = False
    return out


#: Byte is part of a word: all but space and 0x09-0x0D.
NOT_SPACE = _class([(0x20, 0x20), (0x09, 0x0D)])
#: Byte is part of a word: ASCII digits, lower-case letters and all non-ASCII (after lower-casing).
ALNUM = _class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

_pow: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}
_INV = np.uint64(pow(int(MULT), -1, 1 << 64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow["p"]) < n:
        size = next(s for s in (HASH_BYTES + 1, CHUNK_BYTES + 1, n) if s >= n)
        for key, base in (("p", MULT), ("i", _INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _pow[key] = np.multiply.accumulate(x)
    return _pow["p"], _pow["i"]


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the offsets of each text in them (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if not len(off):
        off = np.zeros(1, np.int64)
    return buf[off[0] : off[-1]], off - off[0]


def chunks(off: np.ndarray, size: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``size`` bytes, or of one longer text."""
    size = size or CHUNK_BYTES
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1)
        yield a, b
        a = b


def word_spans(low: np.ndarray, off: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start byte and end byte of all words of the texts in ``low``."""
    inside = word[low]
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = off[:-1][off[:-1] < len(low)]
    before = np.empty(len(low), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(low), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edge[edge > 0] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def word_hashes(buf: np.ndarray, off: np.ndarray, word: np.ndarray, lower: bool = True):
    """Hashes of all words of the texts in ``buf``.

    Returns (hashes, first word of each text with the total at the end,
    start byte, end byte of each word).
    """
    low = LOWER[buf] if lower else buf
    starts, ends = word_spans(low, off, word)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64), starts, ends
    return span_hashes(low, starts, ends), np.searchsorted(starts, off), starts, ends


def span_hashes(low: np.ndarray, starts: np.ndarray, *ends: np.ndarray):
    """Hashes of the bytes from each start to each end; one array for each of ``ends``."""
    p, inv = _powers(len(low) + 1)
    total = np.zeros(len(low) + 1, np.uint64)
    each = total[1:]  # in place, as these are 8 times the text
    np.take(_BYTE, low, out=each, mode="clip")
    each *= p[: len(low)]
    np.cumsum(each, out=each)
    out = [mix((total[e] - total[starts]) * inv[starts] + (e - starts).astype(np.uint64) * NGRAM) for e in ends]
    return out if len(out) > 1 else out[0]


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words (also across texts; callers slice)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = h[:n].copy()
    for j in range(1, k):
        acc *= NGRAM
        acc += h[j : j + n]
    return mix(acc + np.uint64(k))


def shingle_sets(col: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text, words being split at
    white space. Fewer words: the whole sequence as one; none: empty."""
    buf, off = utf8(col)
    for a, b in chunks(off, HASH_BYTES):
        part = buf[off[a] : off[b]]
        h, ptr, _, _ = word_hashes(part, off[a : b + 1] - off[a], NOT_SPACE)
        grams = ngrams(h, k)
        for s, e in zip(ptr[:-1], ptr[1:]):
            if e - s >= k:
                yield np.unique(grams[s : e - k + 1])
            elif e > s:
                yield ngrams(h[s:e], e - s)
            else:
                yield np.zeros(0, np.uint64)
