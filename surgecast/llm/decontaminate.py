"""Benchmark decontamination by winnowing.

Every window of ``span`` words of a text selects the smallest of its k-gram
hashes (the rightmost on ties). The choice depends on the window alone, so two
texts that share ``span`` consecutive words select the same k-gram there: the
join on selected fingerprints loses no shared span. A hit is extended to the
whole window by comparing the hash of its ``span`` words.

Items shorter than ``span`` words, but not empty, are one window each; their
fingerprint is the hash of all their words, which is looked up at every word
of a document.

A document's fingerprints leave the task only if they are in a bit map of the
training of fixed size made from the test items; it has no false negatives, so
it only saves work, and a full map would only save less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surgecast.llm import words
from surgecast.session import materialize, ship_package

#: Words in a window.
SPAN = 13
#: Words in a fingerprinted k-gram; the window holds SPAN - K + 1 of them.
K = 7
#: Bits of the map of item fingerprints (2 MB, whatever the number of items).
MAP_BITS = 1 << 24


def select(grams: np.ndarray, n: int) -> np.ndarray:
    """Position of the rightmost minimum in each ``n`` consecutive values."""
    m = len(grams) - n + 1
    best = grams[:m].copy()
    at = np.zeros(m, np.int64)
    for j in range(1, n):
        cur = grams[j : j + m]
        less = cur <= best
        best[less] = cur[less]
        at[less] = j
    return at + np.arange(m)


def windows(h: np.ndarray, ptr: np.ndarray, span: int, k: int):
    """(text, start, fingerprint, window hash) of every window of ``span`` words."""
    n_windows = np.maximum(ptr[1:] - ptr[:-1] - span + 1, 0)
    text = np.repeat(np.arange(len(ptr) - 1), n_windows)
    if not len(text):
        e = np.zeros(0, np.uint64)
        return text, np.zeros(0, np.int64), e, e
    first = np.cumsum(n_windows) - n_windows
    start = ptr[text] + np.arange(len(text)) - first[text]
    grams = words.ngrams(h, k)
    at = select(grams, span - k + 1)
    return text, start, grams[at[start]], words.ngrams(h, span)[start]


def _item_rows(span: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, off = words.utf8(b.column(1))
            for a, z in words.chunks(off):
                h, ptr, _, _ = words.word_hashes(buf[off[a] : off[z]], off[a : z + 1] - off[a], words.ALNUM)
                text, _, fp, win = windows(h, ptr, span, k)
                size = np.full(len(text), span, np.int32)
                short = [i for i in range(z - a) if 0 < ptr[i + 1] - ptr[i] < span]
                one = [words.ngrams(h[ptr[i] : ptr[i + 1]], ptr[i + 1] - ptr[i])[0] for i in short]
                one = np.array(one, np.uint64)
                ids = b.column(0).slice(a, z - a).take(pa.array(np.r_[text, np.array(short, np.int64)].astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.r_[size, [ptr[i + 1] - ptr[i] for i in short]].astype(np.int32)),
                        pa.array(np.r_[fp, one].view(np.int64)),
                        pa.array(np.r_[win, one].view(np.int64)),
                    ],
                    names=["item_id", "size", "fp", "win"],
                )

    return run


def item_windows(items: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(item_id string, size, fp, win) of every distinct window of the items."""
    src = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text"))
    out = src.mapInArrow(_item_rows(span, k), "item_id string, size int, fp long, win long")
    return out.distinct()


def fingerprint_map(wins: DataFrame) -> np.ndarray:
    """Bit map of the fingerprints, gathered as at most MAP_BITS / 64 words."""
    bit = F.col("fp").bitwiseAND(F.lit(MAP_BITS - 1))
    rows = (
        wins.select(F.shiftright(bit, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toPandas()
    )
    out = np.zeros(MAP_BITS // 64, np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _doc_rows(span: int, k: int, short: list[int], bits):
    def known(fp: np.ndarray) -> np.ndarray:
        at = fp & np.uint64(MAP_BITS - 1)
        return (bits.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0

    kind = pa.list_(pa.struct([("size", pa.int32()), ("fp", pa.int64()), ("win", pa.int64()), ("pos", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, off = words.utf8(b.column(2))
            for a, z in words.chunks(off):
                h, ptr, _, _ = words.word_hashes(buf[off[a] : off[z]], off[a : z + 1] - off[a], words.ALNUM)
                text, start, fp, win = windows(h, ptr, span, k)
                hit = known(fp)
                found = [(np.full(int(hit.sum()), span), text[hit], start[hit], fp[hit], win[hit])]
                for n in short:
                    grams = words.ngrams(h, n)
                    at = np.flatnonzero(known(grams))
                    doc = np.searchsorted(ptr, at, "right") - 1
                    ok = at + n <= ptr[doc + 1]
                    at, doc = at[ok], doc[ok]
                    found.append((np.full(len(at), n), doc, at, grams[at], grams[at]))
                size, doc, at, fp, win = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(doc, kind="stable")
                size, doc, at, fp, win = size[order], doc[order], at[order], fp[order], win[order]
                ends = np.searchsorted(doc, np.arange(z - a + 1))
                hits = pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)),
                    pa.StructArray.from_arrays(
                        [pa.array(size.astype(np.int32)), pa.array(fp.view(np.int64)), pa.array(win.view(np.int64)), pa.array((at - ptr[doc]).astype(np.int64))],
                        fields=list(kind.value_type),
                    ),
                )
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), b.column(1).slice(a, z - a), pa.array((ptr[1:] - ptr[:-1]).astype(np.int64)), hits],
                    names=["row_id", "doc_id", "n_words", "hits"],
                )

    return run


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """Contamination of every row of ``docs`` (doc_id, text) by ``items`` (item_id, text).

    Returns row_id (a number of the input row), doc_id, n_words, n_hit (words
    inside an occurrence of an item's window), n_items, items_sha256,
    contaminated (n_hit > 0 and 20 * n_hit >= n_words). Null and empty texts
    have no words and are clean, in documents and items alike; repeated rows
    are judged one by one; other columns are ignored; empty tables give an
    empty, or an all-clean, result.
    """
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    wins = materialize(item_windows(items, span, k))
    short = [r[0] for r in wins.where(F.col("size") < span).select("size").distinct().orderBy("size").collect()]  # under span values
    bits = spark.sparkContext.broadcast(fingerprint_map(wins))
    src = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = materialize(src.mapInArrow(_doc_rows(span, k, short, bits), f"row_id long, doc_id {kind}, n_words long, hits array<struct<size:int,fp:long,win:long,pos:long>>"))
    cand = found.where(F.size("hits") > 0).select("row_id", F.explode("hits").alias("c")).select("row_id", "c.*")
    keys = ["size", "fp", "win"]
    hits = cand.join(wins.select(*keys).distinct(), keys).select("row_id", "pos", (F.col("pos") + F.col("size")).alias("end"))
    before = Window.partitionBy("row_id").orderBy("pos", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest("pos", F.coalesce(F.max("end").over(before), F.lit(0))))
    n_hit = hits.select("row_id", covered.alias("new")).groupBy("row_id").agg(F.sum("new").alias("n_hit"))
    pairs = cand.select("row_id", *keys).distinct().join(wins, keys).select("row_id", "item_id").distinct()
    per_doc = pairs.groupBy("row_id").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    per_doc = per_doc.select("row_id", F.size("ids").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"))
    out = found.select("row_id", "doc_id", "n_words").join(n_hit.join(per_doc, "row_id"), "row_id", "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "row_id",
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )
