"""SR4 / SR5 at size: large JSON documents cut at the top-level elements of their array, across tasks.

Spark reads the files in splits; within one, text comes as fragments between commas.
A first pass tells for every split how its quotes and brackets change the state, whether
it starts inside a string or not, and how long it is. A running fold over a file's splits,
one small row each, gives the state and the byte position at which each split starts.
The second pass cuts at commas outside strings on the first level, and the pieces of
elements that lie across splits are put together by their position.

An element is known by the byte position of its start, which no split changes, so a
second read gives the same ids. A document that is no array is one element.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUOTE, BACKSLASH, COMMA, SPACE = (ord(c) for c in '"\\, ')
ARRAY_OPEN, ARRAY_CLOSE, OBJECT_OPEN, OBJECT_CLOSE = (ord(c) for c in "[]{}")
FILE = ["_metadata.file_path as path", "_metadata.file_block_start as start",
        "_metadata.file_modification_time as time"]
KEY = ["path", "start", "time"]


def quotes(raw: np.ndarray) -> np.ndarray:
    """Which bytes open or close a string: quotes without an odd run of backslashes before them."""
    found = raw == QUOTE
    slash = raw == BACKSLASH
    if slash.any():
        at = np.arange(len(raw))
        run = at - np.maximum.accumulate(np.where(slash, -1, at))  # backslashes that end here
        found[1:] &= run[:-1] % 2 == 0
    return found


def nesting(raw: np.ndarray, marks: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """(which bytes are outside strings, nesting after each byte), from a start inside a string or not."""
    outside = (np.cumsum(marks) + inside) % 2 == 0
    opens = outside & ((raw == ARRAY_OPEN) | (raw == OBJECT_OPEN))
    closes = outside & ((raw == ARRAY_CLOSE) | (raw == OBJECT_CLOSE))
    return outside, np.cumsum(opens.astype(np.int64) - closes)


def _runs(b: pa.RecordBatch) -> Iterator[tuple[int, tuple, np.ndarray]]:
    """(row, (path, start, time), bytes) of each run of one split's fragments, the commas put back."""
    starts = b.column(1).to_numpy(zero_copy_only=False)
    paths = b.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    edges = np.flatnonzero((starts[1:] != starts[:-1]) | (paths[1:] != paths[:-1])) + 1
    for first, stop in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows]):
        if first < stop:
            text = ",".join(b.column(3).slice(first, stop - first).to_pylist()) + ","
            yield first, tuple(b.column(i)[first].as_py() for i in range(3)), np.frombuffer(text.encode(), np.uint8)


SUMMARY = "path string, start long, part int, odd int, plain long, quoted long, bytes long, array int"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each run of fragments changes the state, starting outside (plain) or inside a string (quoted)."""
    part: dict[tuple, int] = {}
    for b in batches:
        rows = []
        for _, (path, start, _), raw in _runs(b):
            marks = quotes(raw)
            n = part[path, start] = part.get((path, start), -1) + 1
            solid = raw[raw > SPACE]
            rows.append((path, start, n, int(marks.sum() % 2), *(int(nesting(raw, marks, s)[1][-1]) for s in (0, 1)),
                         len(raw), int(start == n == 0 and len(solid) > 0 and solid[0] == ARRAY_OPEN)))
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             [c.split()[0] for c in SUMMARY.split(", ")])


def split_states(fragments: DataFrame) -> DataFrame:
    """(path, start, inside, depth, position, array) at the start of every split.

    A split's runs are folded in order, then a file's splits: being inside a string is a
    running parity, and the nesting adds up what each part does in the state it starts in.
    """
    runs = fragments.select(*KEY, "value").mapInArrow(_summaries, SUMMARY)
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    in_split = Window.partitionBy("path", "start").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    flip = before("odd", in_split) % 2 == 1
    folded = (runs.select("*", flip.alias("flip")).groupBy("path", "start").agg(
        (F.sum("odd") % 2).alias("odd"), F.sum("bytes").alias("bytes"), F.max("array").alias("array"),
        F.sum(F.when(F.col("flip"), F.col("quoted")).otherwise(F.col("plain"))).alias("plain"),
        F.sum(F.when(F.col("flip"), F.col("plain")).otherwise(F.col("quoted"))).alias("quoted")))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    states = folded.select("*", (before("odd", earlier) % 2).alias("inside"))
    change = F.when(F.col("inside") == 1, F.col("quoted")).otherwise(F.col("plain"))
    return states.select("path", "start", "inside", before(change, earlier).alias("depth"),
                         before("bytes", earlier).alias("position"), F.max("array").over(whole).alias("array"))


PIECES = "path string, time timestamp, element long, at long, whole boolean, text string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements that lie in one run, and the pieces of those that begin before it or end behind it."""
    schema = pa.schema([("path", pa.string()), ("time", pa.timestamp("us", "UTC")), ("element", pa.int64()),
                        ("at", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())])
    state: dict[tuple, tuple[int, int, int]] = {}
    for b in batches:
        for row, (path, start, time), raw in _runs(b):
            inside, depth, position = state.get((path, start)) or tuple(b.column(i)[row].as_py() for i in (4, 5, 6))
            marks = quotes(raw)
            outside, level = nesting(raw, marks, inside)
            level = level + depth
            comma = outside & (raw == COMMA)
            cuts, blank = np.empty(0, np.int64), comma & (level <= 0)
            if b.column(7)[row].as_py():
                cuts = np.flatnonzero(comma & (level == 1))
                blank |= outside & (((raw == ARRAY_OPEN) | (raw == COMMA)) & (level == 1)
                                    | (raw == ARRAY_CLOSE) & (level == 0))
            text = np.where(blank, SPACE, raw).astype(np.uint8).tobytes()
            bounds = [0, *(cuts + 1).tolist(), len(raw)]
            spans = list(zip(bounds, bounds[1:]))
            yield pa.RecordBatch.from_pylist([
                {"path": path, "time": time, "element": position + a if k else None, "at": position + a,
                 "whole": 0 < k < len(spans) - 1, "text": text[a:e].decode()} for k, (a, e) in enumerate(spans)], schema)
            state[path, start] = (int((marks.sum() + inside) % 2), int(level[-1]), position + len(raw))


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """(path, time, element, text): the top-level elements of the JSON arrays in a folder's files."""
    fragments = spark.read.option("lineSep", ",").text(path).selectExpr(*FILE, "value")
    # one row a split of the input, some 60 bytes for 128 MB; a shuffle would lose the order of the fragments
    known = fragments.join(F.broadcast(split_states(fragments)), ["path", "start"]).select(
        *KEY, "value", "inside", "depth", "position", "array")
    pieces = known.mapInArrow(_pieces, PIECES)
    # a piece without a start of its own belongs to the last element begun before it
    begun = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    across = (pieces.where("not whole")
              .withColumn("element", F.coalesce(F.last("element", True).over(begun), F.lit(0).cast("long")))
              .groupBy("path", "time", "element").agg(F.array_join(F.transform(F.sort_array(
                  F.collect_list(F.struct("at", "text"))), lambda p: p["text"]), "").alias("text")))
    columns = ["path", "time", "element", "text"]
    return (pieces.where("whole").select(*columns).unionByName(across.select(*columns))
            .withColumn("text", F.btrim("text", F.lit(" \t\r\n"))).where(F.col("text") != ""))
