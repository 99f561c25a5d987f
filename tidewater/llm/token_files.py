"""Token files: patched frame-of-reference blocks of token ids, written and read by Spark.

Documents are range-partitioned by id, encoded, closed with ``END`` and laid end
to end; every partition is one shard, cut at document ends into segments. A
segment is one row of the Parquet container: the lengths and ids of its
documents and one binary payload of blocks of ``BLOCK`` ids. A block holds its
minimum, a bit width, the packed differences from the minimum at the width that
covers ``PERCENTILE`` of them, and the rest as an exception list of (place, high
bits). The payload starts with the index of block starts, so one block can be
read without the others.

Payload (little-endian): u32 ids, u32 blocks, u32 start of each block; block:
u32 minimum, u16 length, u8 width, u8 zero, u16 exceptions, packed bits, then u16
places and u32 high parts.

Defined results: a null text is an empty one; its only id is ``END``. Equal ids
are ordered by text hash, null ids come first; an empty table writes a file
without rows. A very long text is one document of a longer segment. Ids are taken as
longs. Extra columns do not matter.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.bpe import byte_letters, paused_collection, split_words
from tidewater.llm.common import shuffle_partitions

END = 0
BLOCK = 4096
PERCENTILE = 90
SEGMENT = 1 << 18
TABLE_WORDS = 250_000
HEAD = struct.Struct("<IHBBH")
SEGMENT_SCHEMA = ("shard int, segment int, first long, doc_ids array<long>, lengths array<long>, payload binary")


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64-bit values below 2**width as rows of little-endian bit strings.

    64 values of one width fill ``width`` words exactly, so each of the 64 places is one
    shift over all runs of all rows.
    """
    runs = values.reshape(-1, 64)
    words = np.zeros((len(runs), width), "<u8")
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        words[:, word] |= runs[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= runs[:, j] >> np.uint64(64 - shift)
    return words.reshape(len(values), -1).view(np.uint8)


def unpack_bits(packed: np.ndarray, width: int, n: int) -> np.ndarray:
    """The first ``n`` values of each row of ``pack_bits``."""
    words = packed.view("<u8").reshape(-1, width)
    runs = np.zeros((len(words), 64), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        runs[:, j] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            runs[:, j] |= words[:, word + 1] << np.uint64(64 - shift)
    return (runs.reshape(len(packed), -1) & np.uint64((1 << width) - 1))[:, :n].astype(np.uint32)


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """One block for each row; rows of one width are packed together."""
    n = ids.shape[1]
    low = ids.min(axis=1)
    diff = ids - low[:, None]
    at = n * PERCENTILE // 100 - (PERCENTILE == 100)
    widths = np.frexp(np.partition(diff, at, axis=1)[:, at].astype(float))[1]
    out: list[bytes] = [b""] * len(ids)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        mine = diff[rows].astype(np.uint64)
        padded = np.zeros((len(rows), -(-n // 64) * 64), np.uint64)
        padded[:, :n] = mine & np.uint64((1 << width) - 1)
        bits, high = pack_bits(padded, width), (mine >> np.uint64(width)).astype("<u4")
        for row, packed, rest in zip(rows.tolist(), bits, high):
            places = np.flatnonzero(rest)
            out[row] = (HEAD.pack(int(low[row]), n, width, 0, len(places)) + packed[:(n * width + 7) // 8].tobytes()
                        + places.astype("<u2").tobytes() + rest[places].tobytes())
    return out


def pack(ids: np.ndarray) -> bytes:
    whole = len(ids) // BLOCK * BLOCK
    blocks = pack_blocks(ids[:whole].reshape(-1, BLOCK)) if whole else []
    if whole < len(ids):
        blocks += pack_blocks(ids[None, whole:])
    starts = 8 + 4 * len(blocks) + np.cumsum([0, *map(len, blocks)])[:-1]
    return struct.pack("<II", len(ids), len(blocks)) + starts.astype("<u4").tobytes() + b"".join(blocks)


def unpack(payload: bytes) -> np.ndarray:
    """All ids of a payload; blocks of equal length and width are unpacked together."""
    total, n = struct.unpack_from("<II", payload)
    starts = np.frombuffer(payload, "<u4", n, 8).tolist()
    heads = [HEAD.unpack_from(payload, s) for s in starts]
    ids = np.empty((n, BLOCK), np.uint32)
    kinds: dict[tuple[int, int], list[int]] = {}
    for i, (_, size, width, _, _) in enumerate(heads):
        kinds.setdefault((size, width), []).append(i)
    for (size, width), rows in kinds.items():
        bytes_ = (size * width + 7) // 8
        packed = np.zeros((len(rows), -(-size // 64) * 8 * width), np.uint8)
        for k, i in enumerate(rows):
            packed[k, :bytes_] = np.frombuffer(payload, np.uint8, bytes_, starts[i] + HEAD.size)
        values = unpack_bits(packed, width, size) if width else np.zeros((len(rows), size), np.uint32)
        for k, i in enumerate(rows):
            low, odd = heads[i][0], heads[i][4]
            at = starts[i] + HEAD.size + bytes_
            places = np.frombuffer(payload, "<u2", odd, at)
            values[k, places] |= np.frombuffer(payload, "<u4", odd, at + 2 * odd) << np.uint32(width)
            ids[i, :size] = values[k] + np.uint32(low)
    return ids.reshape(-1)[:total]


class Words(dict):
    """Words already encoded; one that is missing comes from the older generation or is made."""

    def __init__(self, older: dict[str, bytes], make: Callable[[str], bytes]):
        self.older, self.make = older, make

    def __missing__(self, word: str) -> bytes:
        made = self[word] = self.older.get(word) or self.make(word)
        return made


class LibraryEncoder:
    """The tokenizer library behind a table of words already encoded.

    A text is cut where the library's pre-tokenizer cuts it and each different
    piece goes through the library's model once; pieces are encoded independently
    there too. The table keeps two generations of about ``TABLE_WORDS`` words; each word of a
    text is looked up once.
    """

    def __init__(self, vocabulary: str):
        import re

        import tokenizers
        self.library = tokenizers.Tokenizer.from_str(vocabulary)
        self.model = self.library.model
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letters = {b: letter for letter, b in byte_letters().items()}
        self.words = Words({}, self.piece)

    def pieces(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return split_words(text)
        return [x for i, part in enumerate(self.at_special.split(text))
                for x in ([part] if i % 2 else split_words(part))]

    def piece(self, piece: str) -> bytes:
        if piece in self.special:
            return array("I", [self.special[piece]]).tobytes()
        # the byte-level alphabet, which writes the printable ASCII characters but space as they are
        spelt = piece.replace(" ", self.letters[32]) if piece.isascii() and piece.isprintable() \
            else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        with paused_collection():
            if len(self.words) > TABLE_WORDS:
                self.words.older = {}
                self.words = Words(self.words, self.piece)
            look = self.words.__getitem__
            return [b"".join(map(look, self.pieces(t))) for t in texts]


@cache
def library_encoder(vocabulary: str) -> LibraryEncoder:
    return LibraryEncoder(vocabulary)


def write_tokens(docs: DataFrame, path: str, vocabulary_path: str, doc_id: str = "doc_id",
                 text: str = "text", partitions: int | None = None) -> None:
    """Encode ``docs`` and write the token files to the folder ``path``."""
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(Path(vocabulary_path).read_text())
    end = np.array([END], "<u4").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library_encoder(vocabulary.value)
        shard, segment, first = TaskContext.get().partitionId(), 0, 0
        ids, parts, held = [], [], 0

        def row() -> pa.RecordBatch:
            payload = pack(np.frombuffer(b"".join(parts), "<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((shard, segment, first, ids, [len(p) // 4 for p in parts], payload),
                                                  arrow.types)], schema=arrow)

        for b in batches:
            for at in range(0, b.num_rows, 500):
                texts = [t or "" for t in b.column(1).slice(at, 500).to_pylist()]
                for doc, made in zip(b.column(0).slice(at, 500).to_pylist(), enc.encode(texts)):
                    ids.append(doc)
                    parts.append(made + end)
                    held += len(parts[-1]) // 4
                    if held >= SEGMENT:
                        yield row()
                        ids, parts, segment, first, held = [], [], segment + 1, first + held, 0
        if ids:
            yield row()

    arrow = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()),
                       ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                       ("payload", pa.binary())])
    n = partitions or shuffle_partitions(spark)
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    (src.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
     .mapInArrow(segments, SEGMENT_SCHEMA)
     .write.option("compression", "none").parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of the token files, ids as binary.

    Only the shards' totals (one row per shard) are summed up in order to place
    each shard; a segment knows its own place in its shard.
    """
    files = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    sizes = files.select("shard", (F.col("first") + F.aggregate(
        "lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("to")) \
        .groupBy("shard").agg(F.max("to").alias("ids"))
    places, before = [], 0
    for r in sizes.orderBy("shard").collect():  # one row per shard, as many as the writer had tasks
        places.append((r["shard"], before))
        before += r["ids"]
    placed = spark.createDataFrame(places, "shard int, base long")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                raw = unpack(r["payload"]).astype("<u4").tobytes()
                ends = np.cumsum(r["lengths"])
                starts = ends - r["lengths"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(starts + r["base"] + r["first"], pa.int64()),
                     pa.array(r["lengths"], pa.int64()),
                     pa.array([raw[4 * s:4 * e] for s, e in zip(starts, ends)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return (files.join(F.broadcast(placed), "shard")
            .select("base", "first", "doc_ids", "lengths", "payload")
            .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary"))
