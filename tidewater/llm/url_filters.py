"""URL filters: allow and block rules found through hashed host-suffix / path-prefix expressions.

A URL is expanded into every pair of a host suffix (whole labels) and a path
prefix (up to each ``/``), no deeper than the deepest rule. Each expression is
hashed with SHA-256; an equi-join on the first four bytes finds candidate rules,
which the full digest then confirms. A rule whose path does not end in ``/`` is
indexed by its last whole segment and confirmed by the rest of its path. Of the
rules that fit, the longest (host plus path) wins, then the longer host, then
block. Only built-in column functions are used.

Defined results: a null url, or one without ``://``, has an empty host and path
and gets the default verdict. Hosts keep ports and user parts as written. An
empty rule table leaves every URL with the default. Repeated rows are judged
once per row of the input (rows equal in id and url give one row each time they
occur); extra columns of the input do not matter; an empty table gives none. A url of any
length is expanded only as deep as the deepest rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower

PREFIX_HEX = 8  # four bytes of the digest


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def folder(path: Column) -> Column:
    """The path up to and with its last ``/``."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 0)


def indexed_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with the digest they are found by and their precedence."""
    r = rules.where(F.col("host").isNotNull() & F.col("action").isin("allow", "block")).select(
        ascii_lower(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("action")).distinct()
    full = digest(F.col("rule_host"), folder(F.col("rule_path")))
    return r.select("*", full.alias("rule_digest"), F.substring(full, 1, PREFIX_HEX).alias("rule_prefix"),
                    F.size(F.split("rule_host", r"\.")).alias("labels"),
                    F.size(F.split("rule_path", "/")).alias("segments"))


def expressions(host: Column, path: Column, labels: Column, segments: Column) -> Column:
    """Digests of the host-suffix x path-prefix pairs down to the given depths."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n, labels)),
                           lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    pieces = F.split(path, "/")
    folders = F.transform(F.sequence(F.lit(1), F.least(F.size(pieces), segments)),
                          lambda k: F.when(k == 1, F.lit("")).otherwise(
                              F.concat(F.array_join(F.slice(pieces, F.lit(1), k - 1), "/"), F.lit("/"))))
    return F.array_distinct(F.flatten(F.transform(
        suffixes, lambda h: F.transform(folders, lambda p: digest(h, p)))))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", page_id: str = "page_id",
                default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict): one row per row of ``pages``.

    The expansion depth is the deepest rule's (one row of statistics). Rows with
    the same id and url share one key; their number is carried through, so
    repeated rows come out as often as they went in.
    """
    indexed = indexed_rules(rules)
    depth = indexed.agg(F.coalesce(F.max("labels"), F.lit(1)).alias("labels"),
                        F.coalesce(F.max("segments"), F.lit(1)).alias("segments")).first()
    p = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"),
                     path_of(F.col(url)).alias("path"))
    counted = p.groupBy("page_id", "host", "path").agg(F.count(F.lit(1)).alias("copies"))
    wide = counted.select("*", F.explode(expressions(
        F.col("host"), F.col("path"), F.lit(depth["labels"]), F.lit(depth["segments"]))).alias("full"))
    keyed = wide.withColumn("prefix", F.substring("full", 1, PREFIX_HEX))
    joined = keyed.join(indexed, F.col("prefix") == F.col("rule_prefix"), "left")
    fits = ((F.col("full") == F.col("rule_digest")) & F.expr("startswith(path, rule_path)")
            & ((F.col("host") == F.col("rule_host"))
               | F.expr("endswith(host, concat('.', rule_host))")))
    rank = F.struct((F.length("rule_host") + F.length("rule_path")).alias("whole"),
                    F.length("rule_host").alias("by_host"), F.col("action").alias("action"),
                    F.concat("rule_host", "rule_path").alias("rule"))
    best = joined.groupBy("page_id", "host", "path", "copies").agg(
        F.max(F.when(fits, rank)).alias("best"))
    return best.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")).drop("_copy")
