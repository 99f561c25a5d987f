"""Quality classifier: interpolated modified Kneser-Ney byte n-grams trained on trusted text.

The model is of order 5 over the bytes of the lower-cased (A-Z) text, so an
n-gram is an exact 40-bit key. Trusted documents (labelled good and not toxic)
are split by a hash: a share of ``CALIBRATE_SHARE`` calibrates, all others train
the model, however many there are. Their texts are found by a bounded filter of their ids, whose
false hits a join removes, so that no other texts are shuffled for it. Counts are sharded by the two bytes before the last: an n-gram, its
context and all lower orders down to three bytes meet in one shard; the tables
of orders one and two are bounded by 65,536 cells and go to every task.

Documents are dealt into blocks; a block sends its different n-grams to the
shards (in salted groups of ``SALT_BLOCKS`` blocks, so no shard's group grows with the
corpus), the join with the counts gives their log probabilities, and these go
back to the block, which sums them per document. The texts are shuffled once.

A document is rejected if its perplexity per byte, or that of its worst stretch
of ``STRETCH`` bytes, lies above the quantile that trusted documents of its
language and length class reach.

Defined results: a null or empty text has no perplexity and is not kept. A null
language is a language of its own; a (language, length) class without ``MIN_CLASS``
trusted documents takes its language's threshold, or the one of all languages.
Without trusted documents nothing is rejected but empty texts. Rows are judged
one by one, repeated rows and null ids alike; very long texts are read whole, in chunks;
an empty table gives an empty one; columns of other names do not reach the result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.arrays import (FOLD, KeyIndex, U, chunks, pack_keys, pack_numbers, summed, text_bytes,
                                  unpack_keys, unpack_numbers)
from tidewater.llm.common import shuffle_partitions, written

ORDER = 5
CALIBRATE_SHARE = 0.3
QUANTILE = 0.99
STRETCH = 48
MIN_CLASS = 50
SALT_BLOCKS = 64
SCALE = 4096  # log10 probabilities travel as -SCALE * log10 p in 16 bits
SHARDS = 64
PENDING = 1 << 22  # n-grams that wait in a task before their counts are summed
FILTER_BITS = 29  # at most 2**FILTER_BITS bits of the filter of training ids: 64 MB
SEGMENT_BITS = 20


def ngram_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(key of the 5 bytes that end at each byte, n+1 row offsets); a text begins after zero bytes."""
    raw, offsets = text_bytes(texts)
    lead = ORDER - 1
    padded = np.zeros(len(raw) + lead * len(texts), np.uint8)
    at = np.arange(len(raw)) + lead * np.repeat(np.arange(1, len(texts) + 1), np.diff(offsets))
    padded[at] = FOLD[raw]
    wide = np.zeros(max(len(padded) - lead, 0), U)
    for j in range(ORDER):
        wide |= padded[j:len(wide) + j].astype(U) << U(8 * (lead - j))
    return with_shard(wide[at - lead]), offsets


def with_shard(keys: np.ndarray) -> np.ndarray:
    """The shard of an n-gram's context above its 40 bits, so that sorted keys are sorted by shard."""
    context = (keys >> U(8)) & U(0xFFFF)
    return keys | (((context * U(0x9E37)) & U(0xFFFF)) * U(SHARDS) >> U(16)) << U(48)


def shard_slices(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    cuts = np.searchsorted(keys, np.arange(SHARDS + 1, dtype=U) << U(48)).tolist()
    return ((s, slice(cuts[s], cuts[s + 1])) for s in range(SHARDS) if cuts[s] < cuts[s + 1])


def levels(keys: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of orders 5 (raw counts) and 4, 3, 2 (continuation counts) of a shard."""
    keys = keys & U((1 << 40) - 1)
    out = [(keys, counts.astype(np.int64))]
    for order in (4, 3, 2):
        out.append(np.unique(out[-1][0] & U((1 << 8 * order) - 1), return_counts=True))
    return out


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts for counts 1, 2 and 3 or more from the numbers of n-grams with counts 1 to 4."""
    n1, n2, n3, n4 = np.maximum(n.astype(float), 1e-9)
    y = n1 / (n1 + 2 * n2)
    raw = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.where(np.isfinite(raw), np.clip(raw, 0.1, [0.95, 1.9, 2.9]), [0.5, 1.0, 1.5])


def interpolated(query: np.ndarray, keys: np.ndarray, counts: np.ndarray, discount: np.ndarray,
                 lower: np.ndarray) -> np.ndarray:
    """Probabilities of one order: discounted share plus the context's left-over weight times ``lower``."""
    if not len(keys):
        return lower
    context = keys >> U(8)
    first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    off = discount[np.minimum(counts, 3) - 1]
    total = np.add.reduceat(counts, first).astype(float)
    spare = np.add.reduceat(off, first) / total
    at = np.minimum(np.searchsorted(keys, query), len(keys) - 1)
    c = np.where(keys[at] == query, counts[at] - off[at], 0.0)
    where = np.minimum(np.searchsorted(context[first], query >> U(8)), len(first) - 1)
    seen = context[first][where] == query >> U(8)
    return np.where(seen, c / total[where] + spare[where] * lower, lower)


@dataclass
class Model:
    """The part of the model that every task holds: discounts of orders 5, 4, 3 and p(byte | byte)."""
    discount: list[np.ndarray]
    pairs: np.ndarray


def small_model(stats: list) -> Model:
    """From the shards' numbers of n-grams with counts 1..4 and their continuation counts of order 2."""
    n = np.zeros((3, 4), np.int64)
    follow = np.zeros(1 << 16, np.int64)
    for r in stats:
        n += np.array(r["numbers"]).reshape(3, 4)
        follow[np.array(r["pairs"], np.int64)] += np.array(r["pair_counts"], np.int64)
    heads = (follow.reshape(256, 256) > 0).sum(axis=0)
    uniform = np.full(256, 1 / 256)
    one = interpolated(np.arange(256, dtype=U), np.flatnonzero(heads).astype(U), heads[heads > 0],
                       discounts(np.bincount(heads, minlength=5)[1:5]), uniform)
    keys = np.flatnonzero(follow)
    pairs = interpolated(np.arange(1 << 16, dtype=U), keys.astype(U), follow[keys],
                         discounts(np.bincount(np.minimum(follow[keys], 9), minlength=5)[1:5]), np.tile(one, 256))
    return Model([discounts(x) for x in n], pairs)


def folded(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of (keys, counts) parts; beside them about as many n-grams wait, ``PENDING`` at least."""
    keys, counts = np.empty(0, U), np.empty(0, np.int64)
    fresh, waiting = [], 0

    def total() -> tuple[np.ndarray, np.ndarray]:
        return summed(np.concatenate([keys, *(k for k, _ in fresh)]),
                      np.concatenate([counts, *(c.astype(np.int64) for _, c in fresh)]))

    for part in parts:
        fresh.append(part)
        waiting += len(part[0])
        if waiting >= max(PENDING, len(keys)):
            keys, counts = total()
            fresh, waiting = [], 0
    return total()


def id_filter(ids: DataFrame) -> tuple[np.ndarray, list[Column]]:
    """A Bloom filter of the column ``doc_id`` and the two places in it that an id takes.

    Some 8 to 16 bits an id up to ``FILTER_BITS``; beyond that only its false hits grow.
    """
    n = ids.count()
    bits = max(SEGMENT_BITS, min(FILTER_BITS, (8 * n).bit_length()))
    places = [F.shiftrightunsigned(F.xxhash64(F.lit(i), F.col("doc_id")), 64 - bits) for i in (23, 29)]

    def segment(table: pa.Table) -> pa.Table:
        held = np.zeros(1 << SEGMENT_BITS, bool)
        held[table["place"].to_numpy() & ((1 << SEGMENT_BITS) - 1)] = True
        return pa.table({"segment": table["segment"].slice(0, 1),
                         "held": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())})

    found = (ids.select(F.explode(F.array(*places)).alias("place")).distinct()
             .withColumn("segment", F.shiftright("place", SEGMENT_BITS)).groupBy("segment")
             .applyInArrow(segment, "segment long, held binary").collect())  # 128 KB a segment
    out = np.zeros((1 << bits - SEGMENT_BITS, (1 << SEGMENT_BITS) // 8), np.uint8)
    for r in found:
        out[r["segment"]] = np.frombuffer(r["held"], np.uint8)
    return out.ravel(), places


def only_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``ids`` (both by ``doc_id``): the filter passes few others and the join drops those."""
    kinds = [x.select("doc_id").schema[0].dataType for x in (rows, ids)]
    if kinds[0] == kinds[1]:  # else the hashes of equal ids differ
        held, places = id_filter(ids)
        shared = rows.sparkSession.sparkContext.broadcast(held)

        @F.pandas_udf("boolean")
        def known(a: pd.Series, b: pd.Series) -> pd.Series:
            a, b = a.to_numpy(), b.to_numpy()
            return pd.Series(((shared.value[a >> 3] >> (a & 7)) & (shared.value[b >> 3] >> (b & 7)) & 1) == 1)

        rows = rows.where(known(*places))
    return rows.join(ids, "doc_id", "left_semi")


def count_ngrams(texts: DataFrame) -> DataFrame:
    """(shard, keys, counts, numbers, pairs, pair_counts): one row per shard that has n-grams."""
    def packed(fresh: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, counts = folded(fresh)
        rows = [(s, pack_keys(keys[at]), pack_numbers(counts[at].astype(np.uint64))) for s, at in shard_slices(keys)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                ["shard", "keys", "counts"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, waiting = [], 0
        for b in batches:
            for _, part in chunks(b.column(0)):
                fresh.append(np.unique(ngram_keys(part)[0], return_counts=True))
                waiting += len(fresh[-1][0])
                if waiting >= PENDING:
                    yield from packed(fresh)
                    fresh, waiting = [], 0
        yield from packed(fresh)

    def merge(table: pa.Table) -> pa.Table:
        keys, counts = folded((unpack_keys(k.as_py()), unpack_numbers(c.as_py()))
                              for k, c in zip(table["keys"], table["counts"]))
        orders = levels(keys, counts)
        numbers = [int((c == k).sum()) for _, c in orders[:3] for k in (1, 2, 3, 4)]
        return pa.table({"shard": table["shard"].slice(0, 1),
                         "keys": pa.array([pack_keys(keys)], pa.binary()),
                         "counts": pa.array([pack_numbers(counts.astype(np.uint64))], pa.binary()),
                         "numbers": [numbers], "pairs": [orders[3][0].astype(np.int64)],
                         "pair_counts": [orders[3][1].astype(np.int64)]})

    return (texts.mapInArrow(local, "shard int, keys binary, counts binary").groupBy("shard")
            .applyInArrow(merge, "shard int, keys binary, counts binary, numbers array<long>, "
                                 "pairs array<long>, pair_counts array<long>"))


def score(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang", blocks: int | None = None) -> DataFrame:
    """(doc_id, lang, n_bytes, log10_prob, worst): worst is the lowest log10 probability of a stretch.

    ``trusted`` (doc_id) lists the training documents, any number of them; all their
    n-grams are counted.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = written(count_ngrams(only_ids(src, trusted).select("text")), "ngram-counts", "none")
    model = small_model(counted.select("numbers", "pairs", "pair_counts").collect())  # a row per shard
    shared = spark.sparkContext.broadcast(model)
    n_blocks = blocks or shuffle_partitions(spark)
    dealt = src.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int"))

    def block_ngrams(table: pa.Table) -> pa.Table:
        keys = np.unique(np.concatenate([np.empty(0, U), *(
            np.unique(ngram_keys(p)[0]) for _, p in chunks(table["text"]))]))
        rows = [(s, pack_keys(keys[at])) for s, at in shard_slices(keys)]
        block = table["block"][0].as_py()
        return pa.table({"shard": pa.array([r[0] for r in rows], pa.int32()),
                         "salt": pa.array([block // SALT_BLOCKS] * len(rows), pa.int32()),
                         "block": pa.array([block] * len(rows), pa.int32()),
                         "keys": pa.array([r[1] for r in rows], pa.binary())})

    def probabilities(queries: pa.Table, counts: pa.Table) -> pa.Table:
        m = shared.value
        orders = levels(unpack_keys(counts["keys"][0].as_py()), unpack_numbers(counts["counts"][0].as_py())) \
            if len(counts) else [(np.empty(0, U), np.empty(0, np.int64))] * 4
        keys = [unpack_keys(k.as_py()) for k in queries["keys"]]
        every = np.unique(np.concatenate([np.empty(0, U), *keys]))
        p = m.pairs[(every & U(0xFFFF)).astype(np.int64)]
        for order in (3, 4, 5):
            p = interpolated(every & U((1 << 8 * order) - 1), *orders[5 - order], m.discount[5 - order], p)
        small = np.minimum(np.round(-np.log10(p) * SCALE), 65_535).astype(np.uint16)
        return pa.table({"block": queries["block"], "shard": queries["shard"], "costs": pa.array(
            [pack_numbers(small[np.searchsorted(every, k)]) for k in keys], pa.binary())})

    def sums(docs: pa.Table, costs: pa.Table) -> pa.Table:
        n = np.zeros(len(docs), np.int64)
        total, worst = np.zeros(len(docs)), np.zeros(len(docs))
        order = np.argsort(costs["shard"].to_numpy())
        cost = np.concatenate([np.empty(0, np.uint16), *(unpack_numbers(costs["costs"][int(i)].as_py())
                                                         for i in order)]).astype(np.int64)
        keys = np.unique(np.concatenate([np.empty(0, U), *(
            np.unique(ngram_keys(p)[0]) for _, p in chunks(docs["text"]))]))
        find = KeyIndex(keys)
        for first, part in chunks(docs["text"]):
            k, offsets = ngram_keys(part)
            running = np.concatenate([[0], np.cumsum(cost[find(k)])]) if len(k) else np.zeros(1, np.int64)
            rows = slice(first, first + len(part))
            n[rows] = np.diff(offsets)
            total[rows] = running[offsets[1:]] - running[offsets[:-1]]
            stretch = running[STRETCH:] - running[:-STRETCH]  # by its start; may reach into the next text
            last = np.maximum(offsets[1:] - STRETCH + 1, offsets[:-1])
            full = np.flatnonzero(last > offsets[:-1])
            worst[rows] = total[rows]
            if len(full):
                cuts = np.stack([offsets[:-1][full], last[full]], axis=1).ravel()
                worst[first + full] = np.maximum.reduceat(np.append(stretch, 0), cuts)[::2]
        return pa.table({"doc_id": docs["doc_id"], "lang": docs["lang"], "n_bytes": n,
                         "log10_prob": -total / SCALE, "worst": -worst / SCALE})

    queries = dealt.groupBy("block").applyInArrow(block_ngrams, "shard int, salt int, block int, keys binary")
    salts = F.sequence(F.lit(0), F.lit((n_blocks - 1) // SALT_BLOCKS))
    table = counted.select("shard", F.explode(salts).alias("salt"), "keys", "counts")
    costs = queries.groupBy("shard", "salt").cogroup(table.groupBy("shard", "salt")).applyInArrow(
        probabilities, "block int, shard int, costs binary")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.select("doc_id", "lang").schema)
    return dealt.groupBy("block").cogroup(costs.groupBy("block")).applyInArrow(
        sums, f"{kinds}, n_bytes long, log10_prob double, worst double")


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, n_bytes, perplexity, worst, max_perplexity, max_worst, kept): one row per row."""
    trusted = (labels.where("doc_id is not null").groupBy("doc_id")
               .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
               .where("quality = 1 and toxic = 0").select("doc_id"))
    place = F.xxhash64(F.lit(17), "doc_id").bitwiseAND(F.lit((1 << 31) - 1)) / float(1 << 31)
    share = 1 - CALIBRATE_SHARE
    scored = written(score(docs, trusted.where(place < share), doc_id, text, lang), "scores")
    per_byte = F.when(F.col("n_bytes") > 0, F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_bytes")))
    per_stretch = F.when(F.col("n_bytes") > 0, F.pow(F.lit(10.0), -F.col("worst")
                                                     / F.least(F.col("n_bytes"), F.lit(STRETCH))))
    s = scored.withColumns({"perplexity": per_byte, "worst": per_stretch,
                            "size_class": F.floor(F.log2(F.greatest("n_bytes", F.lit(1)))),
                            "one": F.lit(0)})
    calibrate = s.join(trusted.where(place >= share), "doc_id", "left_semi").where("n_bytes > 0")

    def limits(*keys: str) -> DataFrame:
        return calibrate.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)).alias("p"),
            F.percentile_approx("worst", F.lit(quantile), F.lit(10_000)).alias("w"))

    # thresholds: at most 64 size classes per language
    by_class = limits("lang", "size_class").where(F.col("n") >= MIN_CLASS)
    by_lang = limits("lang").where(F.col("n") >= MIN_CLASS)
    every = limits("one")
    out = (s.alias("s")
           .join(F.broadcast(by_class).alias("c"), F.col("s.lang").eqNullSafe(F.col("c.lang"))
                 & (F.col("s.size_class") == F.col("c.size_class")), "left")
           .join(F.broadcast(by_lang).alias("l"), F.col("s.lang").eqNullSafe(F.col("l.lang")), "left")
           .join(F.broadcast(every).alias("e"), F.col("s.one") == F.col("e.one"), "left"))
    best = {x: F.coalesce(f"c.{x}", f"l.{x}", f"e.{x}") for x in ("p", "w")}
    return out.select("s.doc_id", "s.lang", "s.n_bytes", "s.perplexity", "s.worst",
                      best["p"].alias("max_perplexity"), best["w"].alias("max_worst")).withColumn(
        "kept", (F.col("n_bytes") > 0)
        & (F.col("max_perplexity").isNull() | ((F.col("perplexity") <= F.col("max_perplexity"))
                                               & (F.col("worst") <= F.col("max_worst")))))
