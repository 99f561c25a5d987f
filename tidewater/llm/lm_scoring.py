"""LM scoring with a log-frequency Bloom filter of n-gram counts.

Training counts unigrams and bigrams of all training documents: tasks count
their own, packed key sets go to shards of the key space, a shard sums them. An
n-gram of count c enters its shard's segment of the filter once for each level up
to 1 + floor(log2(c)), at ``BITS`` bits per level; the segments are written and
stay in their shards. Probing goes up the levels until one is missing; the level's
middle is the count, and bigram and unigram estimates are interpolated.

Documents are dealt into blocks. Each block sends its different words and bigrams
to the shards and gets back their levels, and for the base score, which needs exact
counts, the words' training counts; nothing is broadcast. The texts are shuffled
once (both uses share the exchange). Word keys are 64-bit hashes.

Defined results: a null or blank text consists of its end token. A null doc_id
counts as an empty one when documents are dealt into training and held out.
Every row is scored, repeated rows alike; with no training document all counts
are zero. Very long texts are read whole, in chunks; an empty table gives an empty one;
columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.arrays import (KeyIndex, U, by_shard, chunks, distinct, mix, pack_keys, pack_numbers, shard_bits,
                                  summed, unpack_keys, unpack_numbers, with_ends, word_hashes)
from tidewater.llm.common import shuffle_partitions, written

END = 0x5851F42D4C957F2D  # the end token's key
BITS = 8
PROBES = 3
LEVELS = 48
WEIGHT = 0.6  # of the bigram estimate
FLUSH = 2_000_000


def pair_keys(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(context * U(0xD6E8FEB86659FD93) + token)


def probe(keys: np.ndarray, level: int, i: int) -> np.ndarray:
    return mix(keys + U((level * 0x9E3779B97F4A7C15 + i * 0xC2B2AE3D27D4EB4F) % (1 << 64)))


def local_counts(bits: int):
    """Task function: texts to packed counts (kind 0: words, 1: pairs) per shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            for kind in (0, 1):
                keys, counts = np.unique(np.concatenate([h[kind] for h in held]), return_counts=True)
                counts = counts.astype(np.uint32)
                rows = [(kind, s, pack_keys(keys[at]), pack_numbers(counts[at])) for s, at in by_shard(keys, bits)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                    ["kind", "shard", "keys", "counts"])

        for b in batches:
            for _, part in chunks(b.column(0)):
                seq, _ = with_ends(*word_hashes(part), len(part), END)
                held.append((seq[1:], pair_keys(seq[:-1], seq[1:])))
                if sum(len(h[0]) for h in held) >= FLUSH:
                    yield from flush()
                    held.clear()
        if held:
            yield from flush()

    return run


def segment(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """One shard's part of the filter: packed bits and their number."""
    levels = np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1
    entries = int(levels.sum())
    size = max(64, -(-entries * BITS // 64) * 64)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        k = keys[levels >= level]
        for i in range(PROBES):
            bits[(probe(k, level, i) % U(size)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little"), size


def probed(keys: np.ndarray, data: bytes, size: int) -> np.ndarray:
    """How many levels of each key a segment holds, probing upwards until one is missing."""
    bits = np.frombuffer(data, np.uint8)
    found = np.zeros(len(keys), np.uint8)
    alive = np.arange(len(keys))
    for level in range(1, LEVELS):
        for i in range(PROBES):
            at = (probe(keys[alive], level, i) % U(size)).astype(np.int64)
            alive = alive[(bits[at >> 3] >> (at & 7)) & 1 == 1]
        if not len(alive):
            break
        found[alive] = level
    return found


def counts_of(levels: np.ndarray) -> np.ndarray:
    """The middle of a level's counts: 1, 2.5, 5.5, ... and 0 for none."""
    return np.where(levels > 0, (3 * np.exp2(np.maximum(levels, 1).astype(float) - 1) - 1) / 2, 0.0)


def train(texts: DataFrame, bits: int, text: str = "text") -> tuple[DataFrame, int, int]:
    """Count all of ``texts``: the filter's segments (kind, shard, size, data), tokens and types."""
    def merge(table: pa.Table) -> pa.Table:
        keys, counts = summed(np.concatenate([unpack_keys(k.as_py()) for k in table["keys"]]),
                              np.concatenate([unpack_numbers(c.as_py()) for c in table["counts"]]).astype(np.int64))
        data, size = segment(keys, counts)
        return pa.table({"kind": table["kind"].slice(0, 1), "shard": table["shard"].slice(0, 1),
                         "tokens": [int(counts.sum())], "types": [len(keys)], "size": [size],
                         "data": pa.array([data.tobytes()], pa.binary())})

    packed = "kind int, shard int, keys binary, counts binary"
    merged = (texts.select(text).mapInArrow(local_counts(bits), packed)
              .groupBy("kind", "shard").applyInArrow(
                  merge, "kind int, shard int, tokens long, types long, size long, data binary"))
    merged = written(merged, "lm-filter", "none")
    total = merged.where("kind = 0").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
                                         F.coalesce(F.sum("types"), F.lit(0)).alias("types")).first()
    return merged.select("kind", "shard", "size", "data"), total["tokens"], total["types"]


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text",
          blocks: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row."""
    spark = docs.sparkSession
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                      F.coalesce(held_out, F.lit(False)).alias("held_out"))
    bits = shard_bits(shuffle_partitions(spark))
    segments, tokens, types = train(src.where("not held_out"), bits)
    n_blocks = blocks or 2 * shuffle_partitions(spark)
    size = tokens + 0.5 * (types + 1)
    dealt = src.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int"))

    def block_words(table: pa.Table) -> pa.Table:
        """The block's different words, their counts in its training documents, and its different pairs."""
        seen, trained, pairs = [np.array([END], U)], [np.empty(0, U)], [np.empty(0, U)]
        train_row = ~table["held_out"].to_numpy()
        for first, part in chunks(table["text"]):
            seq, owner = with_ends(*word_hashes(part), len(part), END)
            seen.append(distinct(seq[1:]))
            pairs.append(distinct(pair_keys(seq[:-1], seq[1:])))
            trained.append(seq[1:][train_row[first + owner]])
        keys = distinct(np.concatenate(seen))
        counts = np.zeros(len(keys), np.uint32)
        words, n = np.unique(np.concatenate(trained), return_counts=True)
        counts[np.searchsorted(keys, words)] = n
        pairs = distinct(np.concatenate(pairs))
        rows = [(0, s, pack_keys(keys[at]), pack_numbers(counts[at])) for s, at in by_shard(keys, bits)]
        rows += [(1, s, pack_keys(pairs[at]), None) for s, at in by_shard(pairs, bits)]
        block = table["block"][0].as_py()
        return pa.table({"kind": pa.array([r[0] for r in rows], pa.int32()),
                         "shard": pa.array([r[1] for r in rows], pa.int32()),
                         "block": pa.array([block] * len(rows), pa.int32()),
                         "keys": pa.array([r[2] for r in rows], pa.binary()),
                         "counts": pa.array([r[3] for r in rows], pa.binary())})

    def answers(table: pa.Table, segment: pa.Table) -> pa.Table:
        """Back to each block, in key order: its n-grams' levels, and its words' counts over all
        training documents."""
        counts = [None] * len(table)
        if len(table) and table["kind"][0].as_py() == 0:
            keys = [unpack_keys(k.as_py()) for k in table["keys"]]
            own = [unpack_numbers(c.as_py()).astype(np.int64) for c in table["counts"]]
            every, total = summed(np.concatenate(keys), np.concatenate(own))
            counts = [pack_numbers(total[np.searchsorted(every, k)].astype(np.uint64)) for k in keys]
        levels = []
        for k in table["keys"]:
            k = unpack_keys(k.as_py())
            levels.append(pack_numbers(probed(k, segment["data"][0].as_py(), segment["size"][0].as_py())
                                       if len(segment) else np.zeros(len(k), np.uint8)))
        return pa.table({"block": table["block"], "kind": table["kind"], "shard": table["shard"],
                         "levels": pa.array(levels, pa.binary()), "counts": pa.array(counts, pa.binary())})

    def scored(docs: pa.Table, found: pa.Table) -> pa.Table:
        def column(kind: int, name: str) -> np.ndarray:
            at = np.flatnonzero(found["kind"].to_numpy() == kind)
            at = at[np.argsort(found["shard"].to_numpy()[at])]
            return np.concatenate([unpack_numbers(found[name][int(i)].as_py()) for i in at])

        known = column(0, "counts")
        parts = [(first, len(p), *with_ends(*word_hashes(p), len(p), END)) for first, p in chunks(docs["text"])]
        keys = distinct(np.concatenate([np.array([END], U), *[seq for _, _, seq, _ in parts]]))
        log_exact = np.log10(known + 0.5) - np.log10(size)
        unigram, pair_levels = counts_of(column(0, "levels")), column(1, "levels")
        every = distinct(np.concatenate([distinct(pair_keys(seq[:-1], seq[1:])) for _, _, seq, _ in parts]))
        place = KeyIndex(keys)
        out = {c: np.zeros(len(docs), t) for c, t in (
            ("n_tokens", np.int64), ("n_known", np.int64), ("base", np.float64), ("score", np.float64))}
        for first, n, seq, owner in parts:
            at = place(seq)
            word, context = at[1:], at[:-1]
            pairs, where = np.unique(pair_keys(seq[:-1], seq[1:]), return_inverse=True)
            pair = counts_of(pair_levels[np.searchsorted(every, pairs)])[where]
            before = unigram[context]
            share = np.where(before > 0, np.minimum(pair / np.maximum(before, 1), 1.0), 0.0)
            weight = np.where(before > 0, WEIGHT, 0.0)
            p = weight * share + (1 - weight) * (unigram[word] + 0.5) / size
            rows = slice(first, first + n)
            out["n_tokens"][rows] = np.bincount(owner, minlength=n)
            out["n_known"][rows] = np.bincount(owner, known[word] > 0, minlength=n)
            out["base"][rows] = np.bincount(owner, log_exact[word], minlength=n)
            out["score"][rows] = np.bincount(owner, np.log10(p), minlength=n)
        return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": out["n_tokens"],
                         "n_known": out["n_known"], "train_tokens": np.full(len(docs), tokens),
                         "base_score": out["base"], "score": out["score"]})

    lists = dealt.groupBy("block").applyInArrow(
        block_words, "kind int, shard int, block int, keys binary, counts binary")
    back = lists.groupBy("kind", "shard").cogroup(segments.groupBy("kind", "shard")).applyInArrow(
        answers, "block int, kind int, shard int, levels binary, counts binary")
    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    return dealt.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        scored, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
