"""Corpus-wide line dedup over levelled sorted runs of line hashes.

A run is a Parquet table of line keys, dealt by key and sorted within its
files. Each batch of documents is merge-anti-joined with the runs: keys that
no run holds are new and record their holder (the document that keeps the
line), keys already held only add to the count. The batch then writes its own
run; when a level has ``fanout`` runs, they are compacted into one run of the
next level. Batches come in descending order of doc_id, so the first holder
recorded is the largest doc_id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.session import checkpoint_dir, materialize

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = " \t\n\x0b\x0c\r"
#: Stands for a null doc_id: one document, below all others.
NO_ID = -(1 << 63)


def lines_of(text: Column) -> Column:
    """Lines of a text (null or empty: one empty line)."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without outer white space, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def key_hash(key: Column) -> Column:
    """128 bits: two xxhash64 with different seeds."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


class LineRuns:
    """Levelled sorted runs of (h1, h2, n docs, holder) in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.root = f"{checkpoint_dir(spark)}/line-runs-{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []

    def _write(self, df: DataFrame) -> str:
        path = f"{self.root}/{uuid.uuid4().hex}"
        df.repartition("h1", "h2").sortWithinPartitions("h1", "h2").write.parquet(path)
        return path

    def table(self) -> DataFrame | None:
        """All runs together; a key may be in several of them."""
        paths = [p for level in self.levels for p in level]
        return self.spark.read.parquet(*paths) if paths else None

    def add(self, stats: DataFrame) -> None:
        """Add a batch of (h1, h2, n, holder), one row a key; documents of
        different batches must differ, and come in descending order."""
        held = self.table()
        if held is not None:
            keys = held.select("h1", "h2").distinct()
            new = stats.join(keys, ["h1", "h2"], "left_anti")
            seen = stats.join(keys, ["h1", "h2"], "left_semi").withColumn("holder", F.lit(None).cast("long"))
            stats = new.unionByName(seen)
        run, level = self._write(stats), 0
        while True:
            if len(self.levels) == level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            old, self.levels[level] = self.levels[level], []
            run, level = self._write(_merge(self.spark.read.parquet(*old))), level + 1
            self._delete(old)

    def _delete(self, paths: list[str]) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)

    def frequent(self, min_docs: int) -> DataFrame:
        """Keys of at least ``min_docs`` documents, as (h1, h2, holder); written
        apart, so the runs can go."""
        held = self.table()
        out = materialize(_merge(held).where(F.col("n") >= min_docs).select("h1", "h2", "holder"))
        self._delete([self.root])
        self.levels = []
        return out


def _merge(runs: DataFrame) -> DataFrame:
    return runs.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("holder").alias("holder"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Drop repeated lines from every row of ``docs`` (doc_id, text, ...).

    Keys of at least ``min_chars`` code points held by at least ``min_docs``
    documents lose all lines except those in the largest doc_id holding them.
    Returns the columns of ``docs`` with n_lines, n_dropped and kept (the
    remaining lines) added; columns of these names are replaced. Null and
    empty texts are one empty line, which stays. Rows of the same doc_id are
    one document; null doc_ids are one document, below all others. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    line = docs.select(doc.alias("doc"), F.explode(lines_of(F.col("text"))).alias("line")).select("doc", line_key(F.col("line")).alias("key"))
    keys = materialize(line.where(F.length("key") >= min_chars).select("doc", key_hash(F.col("key")).alias("k")).select("doc", "k.*").distinct())
    lo, hi = keys.where(F.col("doc") != NO_ID).agg(F.min("doc"), F.max("doc")).first()
    runs = LineRuns(spark, fanout)
    cuts = [NO_ID] + [lo + (hi - lo + 1) * i // batches for i in range(1, batches)] if lo is not None else [NO_ID]
    for i in range(len(cuts) - 1, -1, -1):  # a fixed number of batches
        part = keys.where(F.col("doc") >= cuts[i])
        if i + 1 < len(cuts):
            part = part.where(F.col("doc") < cuts[i + 1])
        runs.add(part.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc").alias("holder")))
    hot = runs.frequent(min_docs)
    drops = keys.join(hot, ["h1", "h2"]).where(F.col("doc") != F.col("holder"))
    drops = drops.groupBy("doc").agg(F.collect_list(F.struct("h1", "h2")).alias("drop_keys"))
    held = docs.select(F.struct("*").alias("row"), doc.alias("doc")).join(drops, "doc", "left")
    lines = lines_of(F.col("row.text"))
    stays = lambda x: ~((F.length(line_key(x)) >= min_chars) & F.array_contains(F.col("drop_keys"), key_hash(line_key(x))))
    kept = F.when(F.col("drop_keys").isNull(), lines).otherwise(F.filter(lines, stays))
    out = held.select("row", F.size(lines).cast("long").alias("n_lines"), kept.alias("kept"))
    mine = ("n_lines", "n_dropped", "kept")
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c not in mine],
        "n_lines",
        (F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.concat_ws("\n", "kept").alias("kept"),
    )
