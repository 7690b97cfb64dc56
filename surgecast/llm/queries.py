"""Registered queries of this subpackage: each reads whole tables, applies its
operator with production parameters, and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.llm import collocations, decontaminate, dialogue_repair, html_extract, jaccard_join, langid, line_dedup, packing, piece_codec, quality, sharedfiles, token_files, topk_search, warc
from surgecast.session import prepare_session

PIECES, WORD_BPE, END_ID = "piece_bpe_32k.model", "word_bpe_49k.json", 2


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(_table(spark, sf_dir, "documents"))


def op2_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, expected_grade, tail_prob (probability of the top
    grade: rated good, not toxic), keep."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    rated = labels.select("doc_id", quality.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    model = quality.train(docs, rated)
    return quality.score(docs.select("doc_id", "text"), model, tail_grade=2).drop("text")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    net = langid.train(docs)
    found = langid.identify(docs.select("doc_id", "text"), net)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = piece_codec.tokenize(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(PIECES), decoded="decoded")
    text = F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), text.alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("row_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    index = warc.write_archives(pages, sharedfiles.new_folder(spark, "warc"))
    found = warc.read_archives(index).drop("payload")
    return found.select(warc.page_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_id(F.col("refers_to")).alias("refers_to"))


def op10_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_tokens(_table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE), sharedfiles.new_folder(spark, "tokens"), END_ID)
    return token_files.read_tokens(files).drop("ids")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_repair.report(dialogue_repair.damage(_table(spark, sf_dir, "conversations")))


def op13_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE), END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_exact_topk_search, op3_quality_classifier, op4_language_id, op5_html_extraction, op6_sentencepiece_codec, op7_benchmark_decontamination, op8_line_dedup, op9_warc, op10_token_id_files, op11_phrase_collocations, op12_conversation_repair, op13_sequence_packing)}
