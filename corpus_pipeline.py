"""Training corpus from ``documents``: language, line dedup, near-duplicates,
decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next stage's docs.

Null and empty texts have no letters and go in the first stage; later stages
handle them as their operators say. Repeated rows are copies, of which the
third stage keeps one. Tables without rows give tables without rows. Further
columns of the input, whatever their names, pass through to the last stage,
which replaces columns of the names it adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.llm import decontaminate, jaccard_join, langid, line_dedup, piece_codec, queries, sharedfiles
from surgecast.session import prepare_session


#: Columns that the stages read or write; others travel under names of their place.
KNOWN = ("doc_id", "text", "lang", "n_chars")


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with names no operator's columns clash with."""
    return docs.toDF(*[c if c in KNOWN else f"_col{i}" for i, c in enumerate(docs.columns)])


def _named(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return out.select(*[F.col(a).alias(c) for a, c in zip(_apart(docs).columns, docs.columns)])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; an unknown ``lang`` is filled in."""
    found = langid.identify(_apart(docs), langid.train(docs)).where(F.col("lang_pred") != langid.UNKNOWN)
    return _named(found.withColumn("lang", F.coalesce("lang", "lang_pred")), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines repeated elsewhere; those left without text go."""
    kept = line_dedup.dedup_lines(_apart(docs)).where((F.col("n_dropped") == 0) | (F.btrim("kept", F.lit(" \t\n\x0b\x0c\r")) != ""))
    return _named(kept.withColumns({"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}), docs)


def _with_key(docs: DataFrame) -> DataFrame:
    """``docs`` apart with ``own``: doc_ids in order, null ones last, and the text's hash.

    Rows of one key are copies; doc_ids alone may be null or repeated.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text_hash"))
    return _apart(docs).withColumn("own", key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of copies and near copies, null ids last; of those that share it, one."""
    keyed = _with_key(docs)
    groups = jaccard_join.similar_components(keyed.select(F.col("own").alias("doc_id"), "text"))
    first = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("own")).distinct()
    return _named(keyed.join(first, "own", "left_semi").dropDuplicates(["own"]), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark, each judged by its own text."""
    keyed = _with_key(docs)
    judged = decontaminate.contamination(keyed.select(F.col("own").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    dirty = judged.where("contaminated").select(F.col("doc_id").alias("own")).distinct()
    return _named(keyed.join(dirty, "own", "left_anti"), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of their decoding."""
    both = piece_codec.tokenize(docs, queries.tokenizer_path(queries.PIECES), decoded="decoded").drop("text")
    digests = {
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256),
        "decoded_sha256": F.sha2(F.encode("decoded", "UTF-8"), 256),
    }
    return both.withColumns(digests).drop("decoded")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The first stage trains a network, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    prepare_session(spark)
    folder = sharedfiles.new_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
