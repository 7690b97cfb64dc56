"""Token-id files in Simple-8b word-aligned coding.

A block packs its ids into 64-bit words: the top 4 bits select how many ids of
how many bits the other 60 hold. An id wider than 60 bits is packed as 0 and
escaped: two words behind the packed ones, selector 15 with its position, and
the raw id. A file is the blocks, then a footer with the offset, packed words,
ids and escapes of each block, and the id and length of each document, so
blocks are decoded on their own and all words of one selector at once.

File: magic, blocks (little-endian uint64 words), footer of int64 values
(blocks: byte offset, packed words, ids, escapes; documents: doc_id, tokens),
then the numbers of blocks and documents and the magic.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surgecast.llm import sharedfiles, words
from surgecast.llm.word_tokens import tool_of
from surgecast.session import materialize, ship_package

#: Selector: ids a word, bits an id. Selector 15 is the escape.
COUNTS = [60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
BITS = [60 // n for n in COUNTS]
ESCAPE = 15
MAGIC = b"S8BTOK1\n"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 24
#: Stands for a null doc_id in the files.
NO_ID = -(1 << 63)


def _width(x: np.ndarray) -> np.ndarray:
    """Bits of each uint64."""
    out = np.zeros(len(x), np.int64)
    for s in (32, 16, 8, 4, 2, 1):
        big = (x >> np.uint64(s)) != 0
        out += big * s
        x = np.where(big, x >> np.uint64(s), x)
    return out + (x != 0)


def pack(ids: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Words of a block of uint64 ids; how many are packed ones, and the escapes."""
    ids = np.ascontiguousarray(ids, np.uint64)
    wide = np.flatnonzero(ids >> np.uint64(60))
    small = ids
    if len(wide):
        small = ids.copy()
        small[wide] = 0
    n = len(small)
    width = np.concatenate([_width(small), np.zeros(COUNTS[0], np.int64)])
    choice = np.full(n, len(COUNTS) - 1)
    most = width[:n].copy()  # widest of the next ids
    at = 1
    for s in range(len(COUNTS) - 1, -1, -1):
        while at < COUNTS[s]:
            np.maximum(most, width[at : at + n], out=most)
            at += 1
        choice[most <= BITS[s]] = s
    step = np.array(COUNTS)[choice].tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    at = np.array(starts, np.int64)
    sel = choice[at]
    out = sel.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([small, np.zeros(COUNTS[0], np.uint64)])
    for s, (count, bits) in enumerate(zip(COUNTS, BITS)):
        rows = np.flatnonzero(sel == s)
        for j in range(count):
            out[rows] |= padded[at[rows] + j] << np.uint64(j * bits)
    escapes = np.stack([wide.astype(np.uint64) | np.uint64(ESCAPE << 60), ids[wide]], 1).ravel()
    return np.concatenate([out, escapes]), len(out), len(wide)


def unpack(code: np.ndarray, packed: int, n: int) -> np.ndarray:
    """The ``n`` ids of a block whose first ``packed`` words are packed ones."""
    code, escapes = code[:packed], code[packed:].reshape(-1, 2)
    sel = (code >> np.uint64(60)).astype(np.int64)
    size = np.array(COUNTS)[sel]
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    for s, (count, bits) in enumerate(zip(COUNTS, BITS)):
        rows = np.flatnonzero(sel == s)
        mask = np.uint64((1 << bits) - 1)
        for j in range(count):
            out[start[rows] + j] = (code[rows] >> np.uint64(j * bits)) & mask
    out[(escapes[:, 0] & np.uint64((1 << 60) - 1)).astype(np.int64)] = escapes[:, 1]
    return out[:n]


class TokenFile:
    """Writer of one file; documents are added in order."""

    def __init__(self, path: str):
        self.path, self.out = path, sharedfiles.create(path)
        self.out.write(MAGIC)
        self.at, self.ids, self.waiting, self.held = len(MAGIC), 0, [], 0
        self.blocks: list[tuple[int, int, int, int]] = []
        self.docs: list[tuple[int, int]] = []

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        end = len(ids) if all_of_it else len(ids) // BLOCK_IDS * BLOCK_IDS
        for a in range(0, end, BLOCK_IDS):
            part = ids[a : min(a + BLOCK_IDS, end)]
            code, packed, escapes = pack(part)
            self.blocks.append((self.at, packed, len(part), escapes))
            data = code.astype("<u8").tobytes()
            self.out.write(data)
            self.at += len(data)
        self.waiting, self.held = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(True)
        for rows in (self.blocks, self.docs):
            self.out.write(np.array(rows, "<i8").tobytes())
        self.out.write(np.array([len(self.blocks), len(self.docs)], "<i8").tobytes() + MAGIC)
        self.out.close()


def read_file(path: str) -> Iterator[tuple[int, np.ndarray]]:
    """(doc_id, ids) of each document of a file, block by block."""
    with sharedfiles.open_for_seek(path) as f:
        end = f.size()
        f.seek(end - 16 - len(MAGIC))
        tail = f.read(16 + len(MAGIC))
        if tail[16:] != MAGIC:
            raise ValueError(f"{path} is no token file")
        n_blocks, n_docs = np.frombuffer(tail[:16], "<i8").tolist()
        f.seek(end - 16 - len(MAGIC) - 32 * n_blocks - 16 * n_docs)
        blocks = np.frombuffer(f.read(32 * n_blocks), "<i8").reshape(-1, 4).tolist()
        docs = np.frombuffer(f.read(16 * n_docs), "<i8").reshape(-1, 2)
        have: list[np.ndarray] = []
        held = 0

        def more() -> int:
            at, packed, n, escapes = blocks.pop(0)
            f.seek(at)
            code = np.frombuffer(f.read(8 * (packed + 2 * escapes)), "<u8")
            have.append(unpack(code, packed, n))
            return n

        for doc_id, n in docs.tolist():
            while held < n:
                held += more()
            ids = np.concatenate(have) if len(have) != 1 else have[0]
            have = [ids[n:]]
            held -= n
            yield doc_id, ids[:n]


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None, file_ids: int = FILE_IDS) -> DataFrame:
    """Tokenize ``docs`` (doc_id, text) and write files in ascending doc_id order.

    Returns the manifest, one row a file: path, part and seq (their order is
    that of the files), n_docs, n_ids, start (ids in all earlier files). Null
    and empty texts have the end id only; repeated doc_ids are neighbours,
    ordered by text; null doc_ids come first, as the smallest number. An empty
    table gives no files.
    """
    ship_package(docs.sparkSession)
    tail = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part, files, out = tool_of(tokenizer), TaskContext.get().partitionId(), [], None
        for b in batches:
            _, off = words.utf8(b.column(1))
            for a, z in words.chunks(off):
                ids, at = tool.batch(b.column(1).slice(a, z - a))
                for d, x, y in zip(b.column(0).slice(a, z - a).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    if out is None or out.ids >= file_ids:
                        if out is not None:
                            out.close()
                        out = TokenFile(sharedfiles.unique_name(folder, ".s8b"))
                        files.append(out)
                    out.add(NO_ID if d is None else d, np.concatenate([ids[x:y], tail]))
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pydict(
            {
                "path": pa.array([f.path for f in files], pa.string()),
                "part": pa.array([part] * len(files), pa.int32()),
                "seq": pa.array(range(len(files)), pa.int32()),
                "n_docs": pa.array([len(f.docs) for f in files], pa.int64()),
                "n_ids": pa.array([f.ids for f in files], pa.int64()),
            }
        )

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = src.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    files = materialize(dealt.mapInArrow(run, "path string, part int, seq int, n_docs long, n_ids long"))
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before), n_tokens,
    ids (binary, little-endian unsigned 32-bit), ids_crc32 of these bytes."""
    kind = "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long"
    ship_package(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids", "ids_crc32"]
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows, held = [], 0
                for d, ids in read_file(path):
                    data = ids.astype("<u4").tobytes()
                    rows.append((None if d == NO_ID else d, start, len(ids), data, zlib.crc32(data)))
                    start += len(ids)
                    held += len(data)
                    if held > words.CHUNK_BYTES:
                        yield _rows(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows, names)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path", "start").repartition(n, "path").mapInArrow(run, kind)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
