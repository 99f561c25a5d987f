"""Benchmark decontamination: n-gram windows of the benchmark found in training text.

Both sides are normalised to words (A-Z lower-cased, everything ASCII that is
neither a letter nor a digit separates). A window is ``size`` consecutive words
of an item; an item of fewer words is one window as a whole. The different
windows are a broadcast hash set; every document emits its own windows, a hash
lookup finds candidates and the comparison of the whole window text verifies
them in the same join. Words inside any verified window are hit. Only built-in
column functions are used.

Defined results: null or wordless texts have no words and no hits; wordless
items never occur. Documents are keyed by (doc_id, text), so rows equal in both
give one row. An empty benchmark hits nothing, an empty table has no rows. Items of equal
id count once. Texts of any length are read whole. Extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, let

SIZE = 10
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # ASCII other than digits and lower-case letters
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    none = F.array().cast("array<string>")
    spaced = F.btrim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, " "), F.lit(" "))
    return let(spaced, lambda t: F.when(t == "", none).otherwise(F.split(t, " ")))


def windows(words: Column, size: Column | int) -> Column:
    """All runs of ``size`` words, each joined by single spaces."""
    last = F.size(words) - size + 1
    none = F.array().cast("array<string>")
    return F.when(last >= 1, F.transform(
        F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, size), " "))).otherwise(none)


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                      size: int = SIZE) -> DataFrame:
    """(item_id, size, win): the different windows of every item that has words."""
    w = benchmark.select(F.col(item_id).cast("string").alias("item_id"), words(F.col(text)).alias("w"))
    return (w.where(F.size("w") > 0)
            .withColumn("size", F.least(F.size("w"), F.lit(size)))
            .select("item_id", "size", F.explode(windows(F.col("w"), F.col("size"))).alias("win"))
            .distinct())


def find_hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
              size: int = SIZE) -> DataFrame:
    """(doc_id, key, n_words, size, pos, item_ids): the hits, and one more row per document.

    One pass over the documents: each emits its windows with their positions, a
    left join marks those of the benchmark (with the items that hold them), and
    the first row of each document stays whatever it matched (item_ids null), so
    documents without a hit stay in the result. The broadcast side's bytes are
    measured; beyond ``BROADCAST_BYTES`` the join shuffles instead.
    """
    grams = (benchmark_windows(benchmark, size=size).groupBy("size", "win")
             .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")))
    weight = F.octet_length("win") + F.octet_length(F.array_join("item_ids", ",")) + 64
    stats = grams.groupBy("size").agg(F.sum(weight).alias("bytes")).collect()  # at most ``size`` rows
    sizes = sorted(r["size"] for r in stats) or [size]
    small = sum(r["bytes"] for r in stats) <= BROADCAST_BYTES
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("key"),
                    words(F.col(text)).alias("w"))
    d = d.select("doc_id", "key", F.size("w").alias("n_words"), "w")
    if len(sizes) == 1:
        out = d.select("doc_id", "key", "n_words", F.lit(0).alias("nth"), F.lit(sizes[0]).alias("size"),
                       F.posexplode_outer(windows(F.col("w"), sizes[0])).alias("pos", "win"))
    else:
        by_size = F.array(*[F.struct(F.lit(s).alias("size"), windows(F.col("w"), s).alias("wins"))
                            for s in sizes])
        out = (d.select("doc_id", "key", "n_words", F.posexplode(by_size).alias("nth", "s"))
               .select("doc_id", "key", "n_words", "nth", F.col("s.size").alias("size"),
                       F.posexplode_outer("s.wins").alias("pos", "win")))
    found = out.join(F.broadcast(grams) if small else grams, ["size", "win"], "left")
    first = (F.col("nth") == 0) & (F.coalesce("pos", F.lit(0)) == 0)
    return (found.where(F.col("item_ids").isNotNull() | first)
            .select("doc_id", "key", "n_words", "size", "pos", "item_ids"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  size: int = SIZE) -> DataFrame:
    """One row per document: n_words, n_hit, item_ids (sorted strings), spans, contaminated.

    ``spans`` lists the hit word ranges as (first, last), merged; a document's
    hits are bounded by its own words, so gathering them per document is safe.
    """
    hit = F.col("item_ids").isNotNull()
    per_doc = find_hits(docs, benchmark, doc_id, text, size).groupBy("doc_id", "key", "n_words").agg(
        F.collect_set(F.when(hit, F.struct("pos", "size"))).alias("marks"),
        F.collect_set("item_ids").alias("items"))
    out = per_doc.select("doc_id", "key", F.col("n_words").cast("long").alias("n_words"),
                         merge_spans(F.sort_array("marks")).alias("spans"),
                         F.sort_array(F.array_distinct(F.flatten("items"))).alias("item_ids"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["last"] - s["first"] + 1))
    return out.select("doc_id", "key", "n_words", n_hit.alias("n_hit"), "item_ids", "spans",
                      (F.size("spans") > 0).alias("contaminated"))


def merge_spans(marks: Column) -> Column:
    """Sorted (pos, size) marks to the disjoint word ranges they cover."""
    empty = F.array().cast("array<struct<first:int,last:int>>")

    def step(acc, m):
        end = m["pos"] + m["size"] - 1
        prev = F.get(acc, F.size(acc) - 1)
        joins = (F.size(acc) > 0) & (m["pos"] <= prev["last"] + 1)
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1),
                         F.array(F.struct(prev["first"].alias("first"),
                                          F.greatest(prev["last"], end).alias("last"))))
        new = F.concat(acc, F.array(F.struct(m["pos"].alias("first"), end.alias("last"))))
        return F.when(joins, grown).otherwise(new)

    return F.aggregate(marks, empty, step)


def remove_documents(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = contamination(docs, benchmark, size=size).where("contaminated").select("doc_id", "key")
    keyed = docs.withColumn("_key", F.xxhash64("text"))
    return keyed.join(bad, F.col("_key").eqNullSafe(F.col("key"))
                      & keyed["doc_id"].eqNullSafe(bad["doc_id"]), "left_anti").select(*docs.columns)
