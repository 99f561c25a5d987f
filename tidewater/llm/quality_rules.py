"""Quality rules: base measures and cross-document line frequency per host.

A document's lines are normalised (white space stripped at both ends, lower
case) and hashed; a line found in more than ``min_docs`` different documents of
one host is boilerplate there, however many documents the host has. Boilerplate
is removed from every document but the first that holds it, and a document that
loses more than ``max_removed`` percent of its line characters is depleted and rejected.
Everything runs on built-in column functions.

Defined results: a null or blank text has no words and fails the base rule.
Documents are told apart by their text, so exact copies count once per host and
get the same line statistics; of documents with the smallest id the one of
smallest hash is the first; a null host is a host of its own. Repeated rows
give one result row each, an empty table gives none, texts of any length are
taken whole. Extra columns of the input do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SPACE_CHARS, let, space_words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
NOT_SYMBOLS = r"[^#*$%&|<>]+"
LINE_MIN_DOCS = 10
MAX_REMOVED_PERCENT = 30


def repeated_words(words: Column) -> Column:
    """Words inside a 3-word window that the text holds twice or more.

    Windows are compared by a 64-bit hash; only texts that repeat one at all
    pay for the sort that finds where the repeats stand.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = let(hashes, lambda h: F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))))

    def positions(win: Column) -> Column:
        tagged = F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(tagged, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"])),
            lambda e: e["i"])))

    def covered(pos: Column) -> Column:
        # a window covers 3 words from its start; starts are ascending
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            pos, start,
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"),
                                    p.alias("last")),
            lambda acc: acc["n"])

    return let(windows, lambda win: F.when(
        F.size(F.array_distinct(win)) < F.size(win), covered(positions(win)))
        .otherwise(F.lit(0).cast("long")))


def base_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t = F.coalesce(F.col(text), F.lit(""))
    filled = let(F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""),
                 lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"))
    measured = let(space_words(F.col(text)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
        filled.alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words")))
    out = docs.withColumn("_m", measured)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = out.select(*[c for c in docs.columns if c not in (*names, "base_failed")],
                     *[F.col(f"_m.{n}").alias(n) for n in names])
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def content_key(text: str = "text") -> Column:
    """128-bit identity of a text; null has one of its own."""
    return F.struct(F.xxhash64(F.col(text)).alias("a"),
                    F.xxhash64(F.lit(1), F.col(text)).alias("b"))


def frequent_lines(docs: DataFrame, host: str = "source", text: str = "text", doc_id: str = "doc_id",
                   min_docs: int = LINE_MIN_DOCS) -> DataFrame:
    """(host, line, first_key): hashes of the boilerplate lines of each host.

    ``line`` is the hash, ``first_key`` the content key of the first document
    (smallest id) that holds the line. Counting is two-phase: distinct (host,
    line, document) rows first, so a line that stands in every document of a
    hot host is summed from partial counts and never meets in one task.
    """
    lines = document_lines(docs, host, text, doc_id)
    seen = lines.groupBy("host", "line", "key").agg(F.min("id").alias("id"))
    counts = seen.groupBy("host", "line").agg(
        F.count(F.lit(1)).alias("docs"), F.min(F.struct("id", "key"))["key"].alias("first_key"))
    return counts.where(F.col("docs") > min_docs).select("host", "line", "first_key")


def document_lines(docs: DataFrame, host: str, text: str, doc_id: str) -> DataFrame:
    """One row per document and different normalised line that is not blank."""
    norm = F.transform(F.split(F.col(text), "\n"), lambda x: F.lower(F.btrim(x, F.lit(SPACE_CHARS))))
    hashed = F.array_distinct(F.transform(F.filter(norm, lambda x: x != ""), lambda x: F.struct(
        F.xxhash64(x).alias("line"), F.length(x).alias("chars"))))
    return (docs.select(F.col(host).alias("host"), F.col(doc_id).alias("id"),
                        content_key(text).alias("key"), F.explode(hashed).alias("l"))
            .select("host", "id", "key", "l.line", "l.chars"))


def line_chars(text: Column) -> Column:
    """Characters in a text's different normalised lines."""
    norm = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"),
                       lambda x: F.lower(F.btrim(x, F.lit(SPACE_CHARS))))
    return F.aggregate(F.array_distinct(norm), F.lit(0).cast("long"), lambda a, x: a + F.length(x))


def removed_lines(docs: DataFrame, host: str = "source", text: str = "text", doc_id: str = "doc_id",
                  min_docs: int = LINE_MIN_DOCS) -> DataFrame:
    """(host, id, key, line, chars): the boilerplate lines each document loses.

    The runtime size of the boilerplate side decides how it is joined.
    """
    often = frequent_lines(docs, host, text, doc_id, min_docs)
    lines = document_lines(docs, host, text, doc_id)
    return (lines.alias("d").join(often.alias("f"), (F.col("d.line") == F.col("f.line"))
                                  & F.col("d.host").eqNullSafe(F.col("f.host")))
            .where(F.col("d.key") != F.col("f.first_key"))
            .select("d.*").distinct())


def lost_lines(docs: DataFrame, **params) -> DataFrame:
    """(host, id, key, lost, removed): each document's boilerplate lines (at most its own) and their characters."""
    return removed_lines(docs, **params).groupBy("host", "id", "key").agg(
        F.collect_set("line").alias("lost"), F.sum("chars").alias("removed"))


def without_lines(text: Column, lost: Column) -> Column:
    """A text without the lines whose hashes are ``lost`` (null: none)."""
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(
        lost, F.xxhash64(F.lower(F.btrim(x, F.lit(SPACE_CHARS)))))), "\n")
    return F.when(lost.isNull(), text).otherwise(kept)


def clean_lines(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``; no document is rejected."""
    return _cleaned(docs, docs.select(F.struct("*").alias("_row"), content_key("text").alias("_key")), params, None)


def _cleaned(docs: DataFrame, rows: DataFrame, params: dict, rejected: Column | None) -> DataFrame:
    """The (``_row``, ``_key``, ..) of ``rows`` with lines taken out, but those ``rejected``; n_chars in step."""
    out = rows.join(lost_lines(docs, **params), (F.col("_key") == F.col("key"))
                    & F.col("_row.doc_id").eqNullSafe(F.col("id"))
                    & F.col("_row.source").eqNullSafe(F.col("host")), "left")
    if rejected is not None:
        out = out.where(~F.coalesce(rejected, F.lit(False)))
    text = without_lines(F.col("_row.text"), F.col("lost"))
    fresh = {"text": text, "n_chars": F.when(F.col("lost").isNull(), F.col("_row.n_chars"))
             .otherwise(F.length(text)) if "n_chars" in docs.columns else None}
    return out.select(*[(fresh[f.name].cast(f.dataType) if f.name in fresh else F.col("_row")[f.name]).alias(f.name)
                        for f in docs.schema])


def judge(docs: DataFrame, host: str = "source", text: str = "text", doc_id: str = "doc_id",
          min_docs: int = LINE_MIN_DOCS, max_removed: int = MAX_REMOVED_PERCENT) -> DataFrame:
    """Every row of ``docs`` with the base measures, ``removed_chars``, ``line_chars`` and ``kept``."""
    removed = (removed_lines(docs, host, text, doc_id, min_docs)
               .groupBy("host", "id", "key").agg(F.sum("chars").alias("removed")))
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"),
                       content_key(text).alias("key"), line_chars(F.col(text)).alias("line_chars"))
    base = base_measures(slim, "text").drop("text")
    joined = (base.alias("b").join(removed.alias("r"), (F.col("b.key") == F.col("r.key"))
                                   & F.col("b.doc_id").eqNullSafe(F.col("r.id"))
                                   & F.col("b.host").eqNullSafe(F.col("r.host")), "left")
              .select("b.*", F.coalesce("r.removed", F.lit(0)).alias("removed_chars")))
    return joined.withColumn("kept", ~F.col("base_failed")
                             & (100 * F.col("removed_chars") <= max_removed * F.col("line_chars")))


def keep_documents(docs: DataFrame, max_removed: int = MAX_REMOVED_PERCENT, **params) -> DataFrame:
    """The documents that are kept, with their own columns and without their boilerplate lines.

    The base rule is a filter; documents that lose too much leave by the join that
    brings each document its lost lines, so a text is shuffled once.
    """
    base = base_measures(docs.select("text", F.struct("*").alias("_row"), content_key("text").alias("_key"),
                                     line_chars(F.col("text")).alias("_chars")), "text")
    left = base.where(~F.col("base_failed")).select("_row", "_key", "_chars")
    return _cleaned(docs, left, params, 100 * F.col("removed") > max_removed * F.col("_chars"))
