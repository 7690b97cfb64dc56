"""Phrase collocations by SON partitioning.

Documents are dealt into a fixed number of shards. Each shard is mined
completely at its proportional share of the support: a phrase with ``support``
occurrences in a language has at least ``support * n_i / n`` of them in some
shard, n_i of the language's n words being there. The phrases that are frequent
in any shard are united, and one more pass counts all of them over all
documents exactly, by their text.

Mining is level-wise: pairs first, then phrases of three and four words whose
pairs are all frequent in the shard. A task hashes the words of a few megabytes
of text and adds up equal phrases before the shuffle, so a frequent phrase
costs a row a chunk. Sets of frequent phrases reach the tasks as a bitmap of
fixed size (``BITMAP_BYTES``), whatever the number of phrases: strangers that
it lets through cost work, but the exact counts drop them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surgecast.llm import words
from surgecast.session import materialize, ship_package

#: Longest phrase in words.
LONGEST = 4
SHARDS = 4
#: Words gathered before equal phrases are added up; bounds a task's arrays.
CHUNK_WORDS = 400_000
#: Size of the bitmap of frequent phrases, in slices that tasks fill on their own.
BITMAP_BYTES, SLICES = 1 << 23, 64
ROWS = 1 << 16
#: Bytes of text hashed at a time.
SCAN_BYTES = 1 << 18

#: A byte is part of a word / ends a piece.
IN_WORD = words._class([(0x20, 0x20), (0x09, 0x0D), (0x21, 0x21), (0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F)])
ENDS_PIECE = ~words._class([(0x0A, 0x0D), (0x21, 0x21), (0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F)])


class Words:
    """The words of some texts in order, each with the number of its piece."""

    def __init__(self) -> None:
        self.hash: list[np.ndarray] = []
        self.piece: list[np.ndarray] = []
        self.text: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pieces = self.size = 0

    def add(self, buf: np.ndarray, off: np.ndarray, keep_text: bool) -> None:
        h, first, starts, ends = words.word_hashes(buf, off, IN_WORD)
        if not len(h):
            return
        doc = np.searchsorted(off, starts, "right")
        piece = np.cumsum(ENDS_PIECE[buf])[starts] + doc + self.pieces
        self.pieces = int(piece[-1]) + 1
        self.size += len(h)
        self.hash.append(h)
        self.piece.append(piece)
        if keep_text:
            self.text.append((words.LOWER[buf], starts, ends))

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(self.hash), np.concatenate(self.piece)

    def strings(self) -> pa.Array:
        """The words themselves, in the order of ``hash``."""
        out = []
        for buf, starts, ends in self.text:
            size = ends - starts
            to = np.cumsum(size, dtype=np.int32)
            at = np.arange(int(to[-1]), dtype=np.int32)
            at += np.repeat((starts - (to - size)).astype(np.int32), size)
            off = np.concatenate([[0], to]).astype(np.int32)
            out.append(pa.StringArray.from_buffers(len(starts), pa.py_buffer(off), pa.py_buffer(buf[at])))
        return pa.concat_arrays(out)


def phrases(h: np.ndarray, piece: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each word on; whether they lie in one piece."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    return words.ngrams(h, k), piece[:n] == piece[k - 1 :]


def _key(phrase: np.ndarray, group: int) -> np.ndarray:
    """Place of a phrase of a group (language, or language and shard) in the bitmap."""
    return words.mix(phrase ^ np.uint64(group & 0xFFFFFFFFFFFFFFFF))


def _bits(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each key; the second one lies in the same slice."""
    per = np.uint64(size * 8 // SLICES)
    at = (key >> np.uint64(58)) * per
    return at + key % per, at + (key >> np.uint64(28)) % per


def contains(bitmap: np.ndarray, phrase: np.ndarray, group: int) -> np.ndarray:
    """Whether each phrase of the group may be in the set."""
    a, b = _bits(_key(phrase, group), len(bitmap))
    found = (bitmap[(a >> np.uint64(3)).astype(np.int64)] >> (a & np.uint64(7)).astype(np.uint8)) & 1 > 0
    rest = np.flatnonzero(found)
    b = b[rest]
    found[rest] = (bitmap[(b >> np.uint64(3)).astype(np.int64)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return found


def bitmap_of(found: DataFrame, group: str, size: int = BITMAP_BYTES) -> Broadcast:
    """Bitmap of the phrases (``group``, ``phrase``), built in slices by hash and
    broadcast: ``size`` bytes, however many rows."""
    spark = found.sparkSession

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g, p = (b.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            key = words.mix(p ^ g)
            yield pa.RecordBatch.from_arrays([pa.array((key >> np.uint64(58)).astype(np.int32)), pa.array(key.view(np.int64))], names=["slice", "key"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for b in batches:
            s, key = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
            a, z = _bits(key, size)
            for i in np.unique(s).tolist():
                part = own.setdefault(i, np.zeros(size // SLICES, np.uint8))
                for bit in (a[s == i], z[s == i]):
                    bit = bit - np.uint64(i * (size * 8 // SLICES))
                    np.bitwise_or.at(part, (bit >> np.uint64(3)).astype(np.int64), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int32()), pa.array([x.tobytes() for x in own.values()], pa.binary())], names=["slice", "part"])

    dealt = found.select(group, "phrase").mapInArrow(keys, "slice int, key long").repartition(SLICES, "slice")
    whole = np.zeros(size, np.uint8)
    for s, part in dealt.mapInArrow(fill, "slice int, part binary").collect():
        whole[s * (size // SLICES) : (s + 1) * (size // SLICES)] = np.frombuffer(part, np.uint8)
    return spark.sparkContext.broadcast(whole)


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str], chunk_words: int, keep_text: bool) -> Iterator[dict[tuple, Words]]:
    """The words of the texts by the values of ``keys``, a chunk at a time."""
    held: dict[tuple, Words] = {}
    size = 0
    for b in batches:
        names = b.schema.names
        group = list(zip(*(b.column(names.index(k)).to_pylist() for k in keys)))
        text = b.column(names.index("text"))
        for g in dict.fromkeys(group):
            rows = pa.array([i for i, x in enumerate(group) if x == g]) if len(set(group)) > 1 else None
            buf, off = words.utf8(text.take(rows) if rows is not None else text)
            for a, z in words.chunks(off, SCAN_BYTES):
                w = held.setdefault(g, Words())
                before = w.size
                w.add(buf[off[a] : off[z]], off[a : z + 1] - off[a], keep_text)
                size += w.size - before
                if size >= chunk_words:
                    yield {k: x for k, x in held.items() if x.size}
                    held, size = {}, 0
    yield {k: x for k, x in held.items() if x.size}
    held = {}
    words.release()


def _counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and how often each occurs."""
    if not len(x):
        return x, np.zeros(0, np.int64)
    x = np.sort(x)
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    return x[at], np.diff(np.append(at, len(x)))


def _batches(columns: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(columns, names=names)
    for a in range(0, whole.num_rows, ROWS):
        yield whole.slice(a, ROWS)


def _totals(docs: DataFrame) -> DataFrame:
    """Word occurrences by language and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple, int] = {}
        for b in batches:
            buf, off = words.utf8(b.column(b.schema.names.index("text")))
            inside = IN_WORD[buf]
            start = inside.copy()
            start[1:] &= ~inside[:-1]
            edge = off[:-1][off[:-1] < len(buf)]
            start[edge] = inside[edge]
            to = np.concatenate([[0], np.cumsum(start)])[off]
            for g, x in zip(zip(*(b.column(b.schema.names.index(k)).to_pylist() for k in ("lang", "lang_key", "shard"))), np.diff(to).tolist()):
                n[g] = n.get(g, 0) + x
        yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in n], pa.string()), pa.array([g[1] for g in n], pa.int64()), pa.array([g[2] for g in n], pa.int32()), pa.array(n.values(), pa.int64())], names=["lang", "lang_key", "shard", "n"])

    return docs.mapInArrow(run, "lang string, lang_key long, shard int, n long").groupBy("lang", "lang_key", "shard").agg(F.sum("n").alias("n"))


def _local(docs: DataFrame, sizes: list[int], need: DataFrame, chunk_words: int, known: Broadcast | None) -> DataFrame:
    """(lang_key, shard, phrase) of the phrases of ``sizes`` words frequent in a
    shard; with ``known``, only those all of whose pairs are in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _grouped(batches, ["lang_key", "shard", "group"], chunk_words, False):
            for (lang, shard, group), w in held.items():
                h, piece = w.joined()
                if known is not None:
                    pair, whole = phrases(h, piece, 2)
                    whole[whole] = contains(known.value, pair[whole], group)
                for k in sizes:
                    got, ok = phrases(h, piece, k)
                    if known is not None:
                        for j in range(k - 1):
                            ok = ok & whole[j : j + len(ok)]
                    got, n = _counts(got[ok])
                    cols = [np.full(len(got), lang), np.full(len(got), shard, np.int32), got.view(np.int64), n]
                    yield from _batches([pa.array(c) for c in cols], ["lang_key", "shard", "phrase", "n"])

    found = docs.mapInArrow(run, "lang_key long, shard int, phrase long, n long").groupBy("lang_key", "shard", "phrase").agg(F.sum("n").alias("n"))
    return found.join(need, ["lang_key", "shard"]).where("n >= need").select("lang_key", "shard", "group", "phrase")


def _global(docs: DataFrame, known: Broadcast, support: int, longest: int, chunk_words: int) -> DataFrame:
    """(lang, phrase, k, a): exact counts of at least ``support`` of all words and
    of the longer phrases in ``known``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _grouped(batches, ["lang", "lang_key"], chunk_words, True):
            for (lang, key), w in held.items():
                h, piece = w.joined()
                texts = w.strings()
                for k in range(1, longest + 1):
                    got, ok = phrases(h, piece, k)
                    at = np.flatnonzero(ok)
                    if k > 1:
                        at = at[contains(known.value, got[at], key)]
                    order = at[np.argsort(got[at], kind="stable")]
                    x = got[order]
                    new = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else x.astype(np.int64)
                    first, n = order[new], np.diff(np.append(new, len(x)))
                    parts = [texts.take(pa.array(first + j)) for j in range(k)]
                    said = pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0]
                    yield from _batches([pa.array([lang] * len(n), pa.string()), said, pa.array(np.full(len(n), k, np.int32)), pa.array(n)], ["lang", "phrase", "k", "a"])

    found = docs.mapInArrow(run, "lang string, phrase string, k int, a long").groupBy("lang", "phrase", "k").agg(F.sum("a").alias("a"))
    return found.where(F.col("a") >= support)


def frequent_phrases(docs: DataFrame, support: int = 30, longest: int = LONGEST, shards: int = SHARDS, chunk_words: int = CHUNK_WORDS) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words with at least ``support`` contiguous
    occurrences in a language, as (lang, phrase, k, a), and the languages' word
    counts (lang, n).

    ``docs`` has text and lang; other columns aren't read. Null and empty texts
    have no words, a null lang is ``und``; repeated rows count as often as they
    occur. Tables without words give tables without phrases. A task adds up
    phrases by 64-bit hashes, so two phrases of one chunk would have to share
    one to be mistaken for each other.
    """
    ship_package(docs.sparkSession)
    src = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    src = src.withColumns({"lang_key": F.xxhash64("lang"), "shard": F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int")})
    src = src.withColumn("group", F.xxhash64("lang", "shard"))
    totals = materialize(_totals(src))
    by_lang = totals.groupBy("lang", "lang_key").agg(F.sum("n").alias("all"))
    by_key = by_lang.groupBy("lang_key").agg(F.sum("all").alias("all"))
    share = totals.groupBy("lang_key", "shard").agg(F.sum("n").alias("own"), F.first("lang").alias("lang")).join(by_key, "lang_key").where("own > 0")
    need = share.select("lang_key", "shard", F.xxhash64("lang", "shard").alias("group"), F.ceil(F.expr(f"cast({support} as decimal(10,0)) * own / all")).cast("long").alias("need"))
    pairs = materialize(_local(src, [2], need, chunk_words, None))
    found = pairs
    if longest > 2:
        known = bitmap_of(pairs, "group")
        found = pairs.unionByName(materialize(_local(src, list(range(3, longest + 1)), need, chunk_words, known)))
    candidates = bitmap_of(found.select("lang_key", "phrase").distinct(), "lang_key")
    return materialize(_global(src, candidates, support, longest, chunk_words)), by_lang.select("lang", F.col("all").alias("n"))


def collocations(docs: DataFrame, support: int = 30, longest: int = LONGEST, top: int = 2000, covered: int = 80, shards: int = SHARDS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words: lang, rank,
    phrase, a, l, r, n, score.

    a, l and r are the occurrences of the phrase and of the parts before and
    after its weakest cut, n the language's words, and the score is
    floor(2000000 * a / (l + r)) of the cut where that is least, the first one
    of equals. A phrase goes if ``covered`` percent of its occurrences lie in
    one longer phrase. Order: score, then a, both falling, then phrase in byte
    order. For nulls, repeated rows and empty tables see ``frequent_phrases``.
    """
    found, n = frequent_phrases(docs, support, longest, shards, chunk_words)
    parts = found.select("lang", F.col("phrase").alias("part"), F.col("a").alias("part_a"))
    long = found.where("k > 1").withColumn("ws", F.split("phrase", " "))
    inner = long.where("k > 2").select("lang", "ws", "k", F.col("a").alias("big"))
    inner = inner.withColumn("m", F.explode(F.expr("sequence(2, k - 1)"))).withColumn("i", F.explode(F.expr("sequence(1, k - m + 1)")))
    inner = inner.groupBy("lang", F.expr("array_join(slice(ws, i, m), ' ')").alias("phrase")).agg(F.max("big").alias("big"))
    kept = long.join(inner, ["lang", "phrase"], "left").where(F.expr(f"big IS NULL OR cast(100 as decimal(3,0)) * big < cast({covered} as decimal(3,0)) * a"))
    cuts = kept.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
    cuts = cuts.withColumns({"head": F.expr("array_join(slice(ws, 1, cut), ' ')"), "tail": F.expr("array_join(slice(ws, cut + 1, k), ' ')")})
    cuts = cuts.join(parts.toDF("lang", "head", "l"), ["lang", "head"]).join(parts.toDF("lang", "tail", "r"), ["lang", "tail"])
    cuts = cuts.withColumn("score", F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    ranked = weakest.select("lang", "phrase", "a", "w.l", "w.r", "w.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = ranked.withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
