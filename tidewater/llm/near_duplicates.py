"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

Shingles are runs of five words (A-Z lower-cased, split at ASCII white space); a
shorter text is one shingle. A shingle weighs its count times an inverse document
frequency of 1 for all shingles in at most ``COMMON_SHARE`` of the documents, falling
to 1 - ``IDF_GAIN`` for one that stands in all. Common shingles are found exactly: a
count sketch of all shingles names candidate cells, a second pass counts the
candidates. At most (shingles per document / COMMON_SHARE) can be common, whatever
the corpus size, so that table is broadcast.

Each text gets ``SAMPLES`` consistent weighted samples. Texts that agree in a band of
``ROWS`` samples share a bucket; bands are also joined pairwise into narrower buckets.
Equal texts are collapsed first. A bucket is dealt by hash into blocks of about
``BLOCK`` texts, and all texts of a block are compared by their samples, in one task of
bounded size. Each text proposes its closest partner and its closest among those before
it, so proposals are linear in the bucket; they are verified by the weighted Jaccard
similarity of their whole shingle sets. Buckets that then still hold several classes get
a second look: texts with a likely partner outside their class meet in their block with
their whole shingle sets, and every likely pair of different classes is verified there.
Buckets of several blocks are dealt anew until a round finds no new link between
classes; those that still hold several classes then compare every pair of blocks that
can hold a pair of different classes. Classes are connected components.

Defined results: every input row gets the smallest doc_id of its class. Null texts are
classes of their own; blank texts match equal texts only. Rows equal in id and text are
one document. Null ids belong to the class of their text and are not counted for its id.
Of equal similarities the partner of smaller key is proposed. Very long texts are compared
by all their shingles; an empty table has no classes; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.arrays import (U, by_shard, chunks, mix, pack_keys, pack_numbers, shard_bits, summed,
                                  unpack_keys, unpack_numbers, word_hashes)
from tidewater.llm.common import shuffle_partitions, written

WORDS = 5
SIMILARITY = 0.8
SAMPLES, ROWS = 64, 4
COMMON_SHARE = 1e-3
IDF_GAIN = 0.2
SKETCH_BITS, CELLS = 21, 4096
BLOCK, LEAST_BLOCK = 2048, 64  # texts of a bucket compared in one task; fewer where they are long
BLOCK_SHINGLES = 8_000_000
BOTH = 2  # side of the rows of a block that meets itself
SMALL = 16  # groups of at most so many texts are compared together
EDGES_PER_FILE = 200_000
ESTIMATE = 0.62  # likely pairs; one of SIMILARITY falls below as rarely as it shares no band (2e-4)
MAX_ROWS = 60_000
BITMAP_BITS = 26
_rng = np.random.default_rng(20_240_602)
SLOTS = 1 << 16
# For sample k a shingle draws r ~ Gamma(2), c ~ Gamma(2), beta ~ U(0,1) from a slot hashed by k.
R = _rng.gamma(2, 1, SLOTS).astype(np.float32)
LOG_C = np.log(_rng.gamma(2, 1, SLOTS)).astype(np.float32)
BETA = _rng.random(SLOTS, np.float32)
AT_ONE = LOG_C - R * (1 - BETA) + np.float32(64)  # a sample's value at weight 1, made positive
STEPS = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 48-bit key, count) of each row's different shingles, ordered by row and key."""
    h, row = word_hashes(texts)
    n = np.bincount(row, minlength=len(texts))
    if len(h) >= WORDS:
        whole = np.flatnonzero(row[:len(h) - WORDS + 1] == row[WORDS - 1:])
        key = h[whole]
        for j in range(1, WORDS):
            key = mix(key * U(0xD6E8FEB86659FD93) + h[whole + j])
        owner = row[whole]
    else:
        key, owner = np.empty(0, U), np.empty(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        first = np.searchsorted(row, short)
        extra = h[first]
        for j in range(1, WORDS - 1):
            has = n[short] > j
            more = h[np.minimum(first + j, len(h) - 1)]
            extra = np.where(has, mix(extra * U(0xD6E8FEB86659FD93) + more), extra)
        key, owner = np.append(key, extra), np.append(owner, short)
    both = np.sort((owner.astype(U) << U(48)) | (key >> U(16)))
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.empty(0, np.int64)
    both, count = both[first], np.diff(np.append(first, len(both)))
    return (both >> U(48)).astype(np.int64), both & U((1 << 48) - 1), count


def parts(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    for first, part in chunks(column):
        for at in range(0, len(part), MAX_ROWS):
            yield first + at, part.slice(at, MAX_ROWS)


def cell(keys: np.ndarray) -> np.ndarray:
    return (mix(keys) >> U(64 - SKETCH_BITS)).astype(np.int64)


def common_shingles(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the common shingles and their weights."""
    spark = docs.sparkSession
    texts = docs.select(text)
    total = texts.count()
    least = max(COMMON_SHARE * total, 2)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for b in batches:
            for _, part in parts(b.column(0)):
                counts += np.bincount(cell(shingles(part)[1]), minlength=len(counts)).astype(np.uint32)
        slices = counts.reshape(-1, CELLS)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(slices)), pa.int32()),
                                          pa.array([pack_numbers(s) for s in slices], pa.binary())],
                                         ["part", "counts"])

    def heavy(table: pa.Table) -> pa.Table:
        counts = sum(unpack_numbers(c.as_py()).astype(np.int64) for c in table["counts"])
        return pa.table({"part": table["part"].slice(0, 1),
                         "cells": pa.array([np.packbits(counts >= least).tobytes()], pa.binary())})

    found = (texts.mapInArrow(sketch, "part int, counts binary").groupBy("part")
             .applyInArrow(heavy, "part int, cells binary").collect())  # 2**SKETCH_BITS bits in all
    marked = np.zeros((1 << SKETCH_BITS) // CELLS * CELLS, bool)
    for r in found:
        marked[r["part"] * CELLS:(r["part"] + 1) * CELLS] = np.unpackbits(np.frombuffer(r["cells"], np.uint8))
    shared = spark.sparkContext.broadcast(np.packbits(marked))
    bits = shard_bits(shuffle_partitions(spark))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_heavy = np.unpackbits(shared.value).astype(bool)
        for b in batches:
            for _, part in parts(b.column(0)):
                keys = shingles(part)[1]
                keys, counts = np.unique(keys[is_heavy[cell(keys)]], return_counts=True)
                keys = keys << U(16)
                rows = [(s, pack_keys(keys[at]), pack_numbers(counts[at].astype(np.uint32)))
                        for s, at in by_shard(keys, bits)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                        ["shard", "keys", "counts"])

    def often(table: pa.Table) -> pa.Table:
        keys, counts = summed(np.concatenate([unpack_keys(k.as_py()) for k in table["keys"]]),
                              np.concatenate([unpack_numbers(c.as_py()) for c in table["counts"]]).astype(np.int64))
        keep = counts >= least
        return pa.table({"keys": pa.array([pack_keys(keys[keep])], pa.binary()),
                         "counts": pa.array([pack_numbers(counts[keep].astype(np.uint64))], pa.binary())})

    rows = (texts.mapInArrow(candidates, "shard int, keys binary, counts binary").groupBy("shard")
            .applyInArrow(often, "keys binary, counts binary").collect())
    keys = np.concatenate([np.empty(0, U), *(unpack_keys(r["keys"]) for r in rows)]) >> U(16)
    counts = np.concatenate([np.empty(0), *(unpack_numbers(r["counts"]).astype(float) for r in rows)])
    share = np.maximum(counts / max(total, 1), COMMON_SHARE)
    weight = 1 - IDF_GAIN * np.log(share / COMMON_SHARE) / np.log(1 / COMMON_SHARE)
    order = np.argsort(keys)
    return keys[order], weight[order].astype(np.float32)


def weights(keys: np.ndarray, counts: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, idf = common
    w = counts.astype(np.float32)
    if len(known):
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        w = np.where(known[at] == keys, w * idf[at], w)
    return w


def samples(row: np.ndarray, keys: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """(n, SAMPLES) sample ids; rows without shingles get zeros."""
    out = np.zeros((n, SAMPLES), np.uint32)
    if not len(keys):
        return out
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    x = ((keys >> U(16)) ^ (keys * U(0x9E3779B97F4A7C15) >> U(32))).astype(np.uint32)
    ident = x.astype(U)
    odd = np.flatnonzero(weight != 1)
    log_w = np.log(weight[odd])
    for k in range(SAMPLES):
        slot = (x * STEPS[k]) >> np.uint32(16)
        value = AT_ONE[slot]
        low = ident
        if len(odd):
            s = slot[odd]
            t = np.floor(log_w / R[s] + BETA[s])
            value[odd] = LOG_C[s] - R[s] * (t - BETA[s] + 1) + np.float32(64)
            low = ident.copy()
            low[odd] ^= (t.astype(np.int64).astype(U) * U(0x9E3779B1)) & U(0xFFFFFFFF)
        both = (value.view(np.uint32).astype(U) << U(32)) | low
        out[row[first], k] = (np.minimum.reduceat(both, first) & U(0xFFFFFFFF)).astype(np.uint32)
    return out


def content_key(doc_id: str, text: str) -> Column:
    """128 bits that tell texts apart; a null text has a key by its id."""
    missing = F.concat(F.lit("null text of "), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("="), F.col(text)), missing)))


def sampled(docs: DataFrame, common, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, sig, mini, size): each row's content key, its samples (null without
    shingles), the last byte of each sample, and its number of shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(common)
    src = docs.select(F.col(doc_id).alias("doc_id"), content_key(doc_id, text).alias("key"),
                      F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, part in parts(b.column(2)):
                row, keys, counts = shingles(part)
                sig = samples(row, keys, weights(keys, counts, shared.value), len(part))
                size = np.bincount(row, minlength=len(part))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(part)), b.column(1).slice(first, len(part)),
                     *(pa.array([s.tobytes() if n else None for s, n in zip(kind, size)], pa.binary())
                       for kind in (sig, sig.astype(np.uint8))), pa.array(size, pa.int64())],
                    ["doc_id", "key", "sig", "mini", "size"])

    return src.mapInArrow(run, src.select("doc_id", "key").schema.add("sig", "binary").add("mini", "binary")
                          .add("size", "long"))


def buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, key, size) of every node with samples: its bands, and pairs of neighbouring bands."""
    bands = SAMPLES // ROWS
    wide = 4 * ROWS

    def part(i: int, n: int):
        return F.xxhash64(F.lit(i * 2 + n), F.expr(f"substring(sig, {i * wide + 1}, {n * wide})"))

    every = [part(i, 1) for i in range(bands)] + [part(i, 2) for i in range(0, bands, 2)]
    return nodes.where("sig is not null").select(F.explode(F.array(*every)).alias("bucket"), "key", "size")


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, key, blocks): the members of buckets of two and more, and the bucket's number of blocks."""
    every = buckets(nodes)
    n = F.count(F.lit(1))
    blocks = F.greatest(F.ceil(n / BLOCK), F.least(F.ceil(F.sum("size") / BLOCK_SHINGLES), F.ceil(n / LEAST_BLOCK)))
    several = every.groupBy("bucket").agg(n.alias("n"), blocks.alias("blocks")).where("n > 1")
    return every.select("bucket", "key").join(several.select("bucket", "blocks"), "bucket")


def dealt(members: DataFrame, salt: int) -> DataFrame:
    """The members gathered block by block; ``salt`` deals split buckets anew."""
    block = F.pmod(F.xxhash64("key", "bucket", F.lit(salt)), F.col("blocks"))
    return gathered(members.withColumn("block", block).withColumn("side", F.lit(BOTH)))


def gathered(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "key")


def block_pairs(named: DataFrame) -> DataFrame:
    """The members (with label) of buckets of several classes, in half blocks, once for each pair of
    half blocks they belong to: ``block`` names the pair, ``side`` which of the two the row is of.

    The largest class of a bucket is dealt apart from the rest. Its members need not meet each
    other, so a bucket of n with m members outside that class makes about n * m / BLOCK rows.
    """
    sizes = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.first("blocks").alias("blocks"))
    whole = (sizes.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"),
                                         F.first("blocks").alias("blocks"), F.count(F.lit(1)).alias("classes"))
             .where("classes > 1"))
    halves = 2 * F.col("blocks") / F.col("n")
    cut = whole.select("bucket", F.col("main.label").alias("main"),
                       F.ceil((F.col("n") - F.col("main.n")) * halves).alias("others"),
                       F.ceil(F.col("main.n") * halves).alias("mains"))
    place = F.xxhash64("key", "bucket", F.lit("pair"))
    at = F.when(F.col("label") == F.col("main"), F.col("others") + F.pmod(place, F.col("mains"))).otherwise(
        F.pmod(place, F.col("others")))
    is_main = F.col("at") >= F.col("others")
    partners = F.sequence(F.lit(0).cast("long"), F.when(is_main, F.col("others")).otherwise(
        F.col("others") + F.col("mains")) - 1)
    met = (named.join(cut, "bucket").withColumn("at", at).withColumn("other", F.explode(partners))
           .withColumn("block", F.least("at", "other") * F.lit(1 << 31) + F.greatest("at", "other"))
           .withColumn("side", F.when(F.col("at") == F.col("other"), BOTH)
                       .otherwise((F.col("at") > F.col("other")).cast("int"))))
    return met.select(*named.columns, "block", "side")


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole (bucket, block) groups of sorted input, with the groups' bounds."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        bounds = starts(held)
        if len(bounds) > 2:
            yield held.slice(0, bounds[-2]), bounds[:-1]
            held = held.slice(bounds[-2])
    if held is not None and len(held):
        yield held, starts(held)


def starts(t: pa.Table) -> np.ndarray:
    one, two = t["bucket"].to_numpy(), t["block"].to_numpy()
    new = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(t)]]) if len(t) else np.zeros(1, np.int64)


def agreement(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """(len(one), len(two)) share of equal samples, as counts."""
    out = np.zeros((len(one), len(two)), np.uint8)
    for x, y in zip(np.ascontiguousarray(one.T), np.ascontiguousarray(two.T)):
        out += x[:, None] == y
    return out


def likely_pairs(mini: np.ndarray, bounds: np.ndarray,
                 side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, agreement) of all likely pairs in each group: small groups together, others one by one.
    Groups of two sides are compared across, those of ``BOTH`` within (i < j)."""
    least = int(np.ceil(ESTIMATE * SAMPLES))
    size = np.diff(bounds)
    for n in range(2, SMALL + 1):
        first = bounds[:-1][size == n]
        x, y = np.triu_indices(n, 1)
        step = max(1, 100_000 // len(x))
        for at in range(0, len(first), step):
            i, j = (np.add.outer(first[at:at + step], z).ravel() for z in (x, y))
            agree = (mini[i] == mini[j]).sum(axis=1)
            keep = agree >= least
            if keep.any():
                yield i[keep], j[keep], agree[keep]
    for g in np.flatnonzero(size > SMALL):
        of = side[bounds[g]:bounds[g + 1]]
        one, two = (bounds[g] + np.flatnonzero(of != x) for x in (1, 0))
        agree = agreement(mini[one], mini[two])
        i, j = np.nonzero(np.triu(agree >= least, 1) if of[0] == BOTH else agree >= least)
        if len(i):
            yield one[i], two[j], agree[i, j]


def minis(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["mini"].to_pylist()), np.uint8).reshape(-1, SAMPLES)


def proposals(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, estimate): of each block, every text with its closest partner, and with its closest
    among the texts before it (which ties the texts of a block together)."""

    def closest(one: np.ndarray, other: np.ndarray, agree: np.ndarray) -> np.ndarray:
        order = np.lexsort((other, -agree, one))
        one = one[order]
        return order[np.append(True, one[1:] != one[:-1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in groups(batches):
            key = t["key"].combine_chunks()
            for i, j, agree in likely_pairs(minis(t), bounds, t["side"].to_numpy()):
                both = closest(np.append(i, j), np.append(j, i), np.append(agree, agree)) % len(i)
                at = np.unique(np.append(both, closest(j, i, agree)))
                yield pa.RecordBatch.from_arrays(
                    [key.take(pa.array(i[at])), key.take(pa.array(j[at])), pa.array(agree[at] / SAMPLES)],
                    ["a", "b", "estimate"])

    found = dealt(members.join(nodes.select("key", "mini"), "key"), 0).mapInArrow(
        run, "a binary, b binary, estimate double")
    return found.distinct()


def open_members(members: DataFrame, labels: DataFrame, nodes: DataFrame, salt: int | None) -> DataFrame:
    """The members (with block, side, label, mini) that have a likely partner of another class in their
    block, or without ``salt`` in any block of their bucket."""
    named = members.join(labels, "key")
    mini = nodes.select("key", "mini")
    if salt is None:
        unsettled = gathered(block_pairs(named.join(mini, "key")))
    else:
        several = (named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                   .where("low <> high").select("bucket"))
        unsettled = dealt(named.join(several, "bucket", "left_semi").join(mini, "key"), salt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in groups(batches):
            label = t["label"].combine_chunks().dictionary_encode().indices.to_numpy()
            is_open = np.zeros(len(t), bool)
            for i, j, _ in likely_pairs(minis(t), bounds, t["side"].to_numpy()):
                differ = label[i] != label[j]
                is_open[i[differ]] = is_open[j[differ]] = True
            yield from t.filter(pa.array(is_open)).to_batches()

    return unsettled.mapInArrow(run, unsettled.schema)


def links_between(members: DataFrame, vecs: DataFrame) -> DataFrame:
    """(a, b): verified links between classes of the open members, found block by block."""
    met = (members.join(vecs, "key").repartition("bucket", "block")
           .sortWithinPartitions("bucket", "block", "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in groups(batches):
            label = t["label"].combine_chunks().dictionary_encode().indices.to_numpy().copy()
            key, vec = t["key"].combine_chunks(), t["vec"].combine_chunks()
            for i, j, _ in likely_pairs(minis(t), bounds, t["side"].to_numpy()):
                differ = label[i] != label[j]
                i, j = i[differ], j[differ]
                if not len(i):
                    continue
                order = np.argsort(i, kind="stable")
                used, place = np.unique(np.append(i[order], j[order]), return_inverse=True)
                compare = Comparison([vec[int(x)] for x in used])
                links = []
                for x, others in zip(*runs(place[:len(i)], place[len(i):])):
                    others = others[label[used[others]] != label[used[x]]]
                    if len(others):
                        for y in others[compare(x, others) >= SIMILARITY]:
                            if label[used[x]] != label[used[y]]:
                                links.append((used[x], used[y]))
                                label[label == label[used[y]]] = label[used[x]]
                if links:
                    a, b = zip(*links)
                    yield pa.RecordBatch.from_arrays([key.take(pa.array(a)), key.take(pa.array(b))], ["a", "b"])

    return met.mapInArrow(run, "a binary, b binary")


def runs(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each value of the sorted ``i`` and the parts of ``j`` that stand beside it."""
    first = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
    return i[first], np.split(j, first[1:])


def bitmap(rows: DataFrame, slot: Column) -> np.ndarray:
    """2**BITMAP_BITS bits, those of the rows' slots set; of the same size for any corpus."""
    width = 1 << 15

    def bits(t: pa.Table) -> pa.Table:
        out = np.zeros(width, bool)
        out[t["place"].to_numpy()] = True
        return pa.table({"part": t["part"].slice(0, 1), "bits": pa.array([np.packbits(out).tobytes()], pa.binary())})

    slots = rows.select(slot.alias("slot")).distinct().select(
        F.floor(F.col("slot") / width).cast("int").alias("part"), (F.col("slot") % width).cast("int").alias("place"))
    whole = np.zeros((1 << BITMAP_BITS) // width * (width // 8), np.uint8)
    for r in slots.groupBy("part").applyInArrow(bits, "part int, bits binary").collect():
        whole[r["part"] * (width // 8):(r["part"] + 1) * (width // 8)] = np.frombuffer(r["bits"], np.uint8)
    return whole


def vectors(docs: DataFrame, wanted: DataFrame, common, doc_id: str, text: str) -> DataFrame:
    """(key, vec): 32-bit shingle keys and weights of the wanted (key, doc_id) documents.

    A broadcast bitmap of fixed size holds back most other texts before the join, which is exact.
    Rows equal in key and doc_id give one vector: one a task, then one of all.
    """
    slot = F.pmod(F.xxhash64("key", "doc_id"), F.lit(1 << BITMAP_BITS))
    context = docs.sparkSession.sparkContext
    shared, marked = context.broadcast(common), context.broadcast(bitmap(wanted, slot))
    src = docs.select(F.col(doc_id).alias("doc_id"), content_key(doc_id, text).alias("key"),
                      F.col(text).alias("text")).withColumn("slot", slot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            at = b.column(3).to_numpy()
            b = b.filter(pa.array((marked.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)))
            new = np.zeros(len(b), bool)
            for i, row in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                new[i] = row not in seen
                seen.add(row)
            b = b.filter(pa.array(new))
            for first, part in parts(b.column(2)):
                row, keys, counts = shingles(part)
                w = weights(keys, counts, shared.value).astype(np.float32)
                short = (keys >> U(16)).astype(np.uint32)
                cuts = np.searchsorted(row, np.arange(len(part) + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(part)), b.column(1).slice(first, len(part)),
                     pa.array([short[s:e].tobytes() + w[s:e].tobytes()
                               for s, e in zip(cuts, cuts[1:])], pa.binary())], ["doc_id", "key", "vec"])

    made = src.mapInArrow(run, src.select("doc_id", "key").schema.add("vec", "binary"))
    # inside a struct a null id equals a null id
    ident = F.struct("doc_id").alias("id")
    return (made.select("key", ident, "vec").join(wanted.select("key", ident), ["key", "id"], "left_semi")
            .dropDuplicates(["key", "id"]).select("key", "vec"))


class Comparison:
    """Weighted Jaccard among vectors: sum of the smaller weights over the sum of the larger."""

    def __init__(self, vecs: list[pa.Scalar]):
        data = [v.as_buffer() for v in vecs]
        n = np.array([len(d) // 8 for d in data])
        keys = np.concatenate([np.frombuffer(d, np.uint32, m) for d, m in zip(data, n)])
        weight = np.concatenate([np.frombuffer(d, np.float32, m, 4 * m) for d, m in zip(data, n)]).astype(np.float64)
        known, ids = np.unique(keys, return_inverse=True)
        cuts = np.cumsum(n)[:-1]
        self.ids, self.weight = np.split(ids, cuts), np.split(weight, cuts)
        self.total = np.array([w.sum() for w in self.weight])
        self.dense = np.zeros(len(known))

    def __call__(self, x: int, others: np.ndarray) -> np.ndarray:
        self.dense[self.ids[x]] = self.weight[x]
        weight = np.concatenate([self.weight[y] for y in others])
        smaller = np.minimum(self.dense[np.concatenate([self.ids[y] for y in others])], weight)
        first = np.cumsum([0, *(len(self.ids[y]) for y in others[:-1])])
        low = np.add.reduceat(smaller, first)
        self.dense[self.ids[x]] = 0
        return low / (self.total[x] + self.total[others] - low)


def verified(pairs: DataFrame, vecs: DataFrame) -> DataFrame:
    """(a, b) of the pairs whose similarity is at least ``SIMILARITY``."""
    both = (pairs.select("a", "b").join(vecs.withColumnsRenamed({"key": "a", "vec": "x"}), "a")
            .join(vecs.withColumnsRenamed({"key": "b", "vec": "y"}), "b").select("a", "b", "x", "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [Comparison([x, y])(0, np.array([1]))[0] >= SIMILARITY for x, y in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of an undirected graph: alternating large and small stars until nothing moves."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u <> v").distinct(), "star")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m")
                 .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        # stars never have more edges than before, so their number sizes the next files
        edges = written(small.coalesce(max(1, state[0] // EDGES_PER_FILE)), "star")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after joining the classes that the links connect."""
    ends = (links.join(labels.select(F.col("key").alias("a"), F.col("label").alias("x")), "a")
            .join(labels.select(F.col("key").alias("b"), F.col("label").alias("y")), "b")
            .select(F.col("x").alias("a"), F.col("y").alias("b")))
    roots = components(ends)
    return written(labels.join(roots, labels["label"] == roots["node"], "left")
                   .select("key", F.coalesce("root", "label").alias("label")), "labels")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, class_id), one row per row: class_id is the smallest doc_id of the class."""
    common = common_shingles(docs, text)
    rows = written(sampled(docs, common, doc_id, text), "samples")
    nodes = written(rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"), *(
        F.first(c).alias(c) for c in ("sig", "mini", "size"))), "texts")
    members = written(shared_buckets(nodes), "buckets")
    labels = written(members.select("key").distinct().select("key", F.col("key").alias("label")), "labels")
    vecs = written(vectors(docs, nodes.select("key", "doc_id").join(labels.select("key"), "key", "left_semi"),
                           common, doc_id, text), "vectors", "none")
    # most links: the best proposal of each text; what then is one class needs no check
    pairs = written(proposals(members, nodes), "pairs")
    best = pairs.groupBy("a").agg(F.max(F.struct("estimate", "b"))["b"].alias("b"))
    labels = merged(labels, written(verified(best, vecs), "links"))
    rest = (pairs.join(best, ["a", "b"], "left_anti")
            .join(labels.withColumnsRenamed({"key": "a", "label": "x"}), "a")
            .join(labels.withColumnsRenamed({"key": "b", "label": "y"}), "b").where("x <> y"))
    labels = merged(labels, written(verified(rest.select("a", "b"), vecs), "links"))
    # what is likely and not yet one class is verified pair by pair; split buckets are dealt anew until
    # nothing is new, which leaves few classes, then all their blocks meet
    salt, split = 1, members.where("blocks > 1")
    while True:
        likely = written(open_members(members, labels, nodes, salt), "open")
        links = written(links_between(likely, vecs), "links")
        if links.isEmpty():
            break
        labels = merged(labels, links)
        members = split
        salt += 1
    links = written(links_between(written(open_members(split, labels, nodes, None), "open"), vecs), "links")
    if not links.isEmpty():
        labels = merged(labels, links)
    named = nodes.select("key", "doc_id").join(labels, "key", "left").select(
        "key", F.coalesce("label", "key").alias("label"), "doc_id")
    lowest = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    by_key = written(named.join(lowest, "label").select("key", "class_id"), "classes")
    return rows.select("doc_id", "key").join(by_key, "key").select("doc_id", "key", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class of ``docs``: the one of smallest doc_id."""
    found = classes(docs)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select("doc_id", "key").distinct()
    keyed = docs.withColumn("_key", content_key("doc_id", "text"))
    left = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["doc_id"]) & (keyed["_key"] == gone["key"]), "left_anti")
    return left.dropDuplicates(["doc_id", "_key"]).select(*docs.columns)
