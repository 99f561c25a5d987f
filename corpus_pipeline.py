"""The corpus pipeline: five stages, each one operator of ``tidewater.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each result as Parquet to the shared folder and reads it back as the
next stage's documents.

Defined results: null, empty and blank texts fail the base rule of the first stage
and go, as do repeated rows but one in the third; null ids, languages and sources
are values of their own; texts of any length are taken whole; an empty table gives
an empty one; extra columns stay, but ``ids``, ``n_tokens`` and ``round_trip`` are
replaced by the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontaminate, line_dedup, near_duplicates, quality_rules
from tidewater.llm.common import table, written
from tidewater.session import configure

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, the others lose their boilerplate lines."""
    return quality_rules.keep_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a text that changes keeps ``n_chars`` in step."""
    return line_dedup.drop_lines(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one of smallest id."""
    return near_duplicates.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, and whether they decode to its text again.

    The ids are written first: one Python worker a task, not an encoder and a decoder at once.
    """
    coded = written(bpe.encode(docs, VOCABULARY), "pipeline-ids")
    back = bpe.decode(coded, VOCABULARY, text="_decoded")
    return (back.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
            .withColumn("round_trip", F.col("_decoded") == F.coalesce("text", F.lit(""))).drop("_decoded"))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_duplicates", near_duplicate),
          ("decontaminate", decontaminated), ("bpe", tokens)]

# Sampling and exact merging are beyond SQL; tests/llm checks what run() must keep and drop.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
