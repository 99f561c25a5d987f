"""Contract queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tidewater.llm import (bpe, decontaminate, divergence, language_id, line_dedup, lm_scoring, merkle,
                           near_duplicates, quality_classifier, quality_rules, sentence_pieces, token_files,
                           url_filters)
from tidewater.llm.common import table
from tidewater.llm.oracle import ORACLE as ORACLE
from tidewater.session import configure, shared_dir

# The contract's URL rules (fixed values).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, VOCABULARY).drop("text")
    return bpe.decode(coded, VOCABULARY, text="decoded").select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return near_duplicates.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    path = shared_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, VOCABULARY)
    return token_files.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                        "contaminated")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filters.filter_urls(table(spark, sf_dir, "pages"), rules)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    return language_id.identify(docs, held_out).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    return lm_scoring.score(table(spark, sf_dir, "documents"), held_out)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return line_dedup.drop_repeated(docs).select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    given = merkle.leaf(*(merkle.lowered(F.col(f)) if f == "text" else F.col(f) for f in merkle.FIELDS))
    return merkle.manifest(docs, F.when(tampered, given)).drop("idx")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentence_pieces.encode(docs, PIECES).drop("text")
    return sentence_pieces.decode(coded, PIECES, text="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_classifier, op2_bpe, op3_near_duplicates, op4_token_files, op5_decontaminate,
                            op6_url_filters, op7_quality_rules, op8_language_id, op9_lm_scoring, op10_line_dedup,
                            op11_merkle_manifest, op12_source_divergence, op13_sentencepiece)}
