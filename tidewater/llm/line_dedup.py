"""Line dedup with levelled sorted runs of line hashes.

A run is a Parquet folder of (hash, docs, last_doc) rows, one row per hash,
dealt into hash ranges and sorted. Each new batch of documents is reduced to one
row per line hash and merge-anti-joined with the runs: what no run holds is new
and goes into a level-0 run with its last holder; what some run holds only
adds its document count. When a level has ``FANOUT`` runs they are compacted
into one run of the next level (counts summed, last holders kept).

Batches go through descending document ids, so the first batch that brings a
hash also brings the largest document id holding it. After the last batch the
runs are compacted once more and give the lines to drop: those in at least
``min_docs`` documents, everywhere but in their last holder.

Defined results: a null or empty text is one empty line. A null doc_id counts as
smaller than all others. Rows with the same doc_id are one document when
documents are counted, and each row loses its own lines. Extra columns do not
matter; an empty table gives an empty result. Texts of any length are read whole. Ids are
taken as longs; a text id that is no number ends the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import shuffle_partitions, written

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 3
NO_ID = -(1 << 63)
SPACE = b" \t\n\x0b\x0c\r"


def line_hash(line: bytes) -> bytes | None:
    """128-bit hash of a line's key (stripped, A-Z lower-cased); None if the key is short."""
    key = line.strip(SPACE).lower()  # bytes.lower changes A-Z only
    if len(key) < MIN_CHARS or (not key.isascii() and len(key.decode()) < MIN_CHARS):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def line_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, line): the different line hashes of each row's text."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lines = [], []
            for doc, value in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
                raw = value.as_py()
                if raw:
                    found = {line_hash(x) for x in raw.split(b"\n")} - {None}
                    ids += [doc] * len(found)
                    lines += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lines, pa.binary())],
                                             ["doc", "line"])

    src = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text))
    return src.mapInArrow(hashes, "doc long, line binary")


class SortedRuns:
    """Levels of sorted runs; ``add`` takes one batch, ``compacted`` returns the merged store."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def _run(self, rows: DataFrame, name: str) -> DataFrame:
        n = shuffle_partitions(self.spark)
        return written(rows.repartition(n, "line").sortWithinPartitions("line"), name)

    def add(self, rows: DataFrame) -> DataFrame:
        """Add a batch of (line, docs, last_doc) rows, one per line; returns the new lines' run.

        Lines that some run holds keep the run's last holder, so their row only adds to the count.
        """
        new = rows.withColumn("fresh", F.lit(True))
        for run in (r for level in self.levels for r in level):
            held = run.where("last_doc is not null").select(F.col("line").alias("_held"))
            new = (new.join(held, F.col("line") == F.col("_held"), "left")
                   .withColumn("fresh", F.col("fresh") & F.col("_held").isNull()).drop("_held"))
        run = self._run(new.select("line", "docs", F.when(F.col("fresh"), F.col("last_doc")).alias("last_doc")),
                        "line-run")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(run)
        self._settle()
        return run.where("last_doc is not null")

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        both = runs[0]
        for r in runs[1:]:
            both = both.unionByName(r)
        return both.groupBy("line").agg(F.sum("docs").alias("docs"), F.max("last_doc").alias("last_doc"))

    def _settle(self) -> None:
        for i in range(len(self.levels)):
            if len(self.levels[i]) >= self.fanout:
                merged = self._run(self._merge(self.levels[i]), "line-level")
                self.levels[i] = []
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(merged)

    def compacted(self) -> DataFrame:
        """All lines of the store, one row per line."""
        return self._merge([r for level in self.levels for r in level])


def repeated_lines(lines: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(line, last_doc) of the lines in at least ``min_docs`` documents; ``lines`` is (doc, line)."""
    spark = lines.sparkSession
    cuts = lines.agg(F.percentile_approx("doc", [i / batches for i in range(1, batches)], 1000)).first()[0]
    bounds = [None, *sorted(set(cuts or [])), None]
    runs = SortedRuns(spark)
    for low, high in reversed(list(zip(bounds[:-1], bounds[1:]))):
        part = lines
        if low is not None:
            part = part.where(F.col("doc") > low)
        if high is not None:
            part = part.where(F.col("doc") <= high)
        runs.add(part.distinct().groupBy("line").agg(
            F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last_doc")))
    return written(runs.compacted().where(F.col("docs") >= min_docs).select("line", "last_doc"), "line-repeated")


def drop_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs`` with repeated lines dropped from the text, plus ``n_lines`` and ``n_dropped``."""
    lines = written(line_rows(docs, doc_id, text), "lines")
    repeated = repeated_lines(lines, min_docs, batches)
    drops = (lines.alias("l").join(repeated.alias("r"), F.col("l.line") == F.col("r.line"))
             .where(F.col("doc") != F.col("last_doc"))
             .select("l.doc", "l.line").distinct()
             .groupBy("doc").agg(F.collect_list("line").alias("_drops")))  # at most a document's own lines
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    keyed = docs.select(*names).withColumn("_doc", F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)))
    joined = keyed.join(drops, keyed["_doc"] == drops["doc"], "left").select(*names, "_drops")
    at = names.index(text)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, n_lines, n_dropped = [], [], []
            for value, drop in zip(b.column(at), b.column(len(names))):
                raw, gone = value.as_py() or "", drop.as_py()
                total = raw.count("\n") + 1
                n_lines.append(total)
                if gone is None:
                    kept.append(raw if value.is_valid else None)
                    n_dropped.append(0)
                    continue
                held = set(gone)
                left = [x for x in raw.split("\n") if line_hash(x.encode()) not in held]
                kept.append("\n".join(left))
                n_dropped.append(total - len(left))
            cols = [b.column(i) for i in range(len(names))]
            cols[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                [*names, "n_lines", "n_dropped"])

    schema = joined.drop("_drops").schema.add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(cleaned, schema)


def drop_lines(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with the repeated lines dropped; ``n_chars``, where there is one, follows the text."""
    out = drop_repeated(docs, **params).select(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long")))
    return out
