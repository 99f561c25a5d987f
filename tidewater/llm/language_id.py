"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's subwords are its runs of 2, 3 and 4 bytes (A-Z lower-cased), hashed
into ``BUCKETS``. Their embeddings are averaged over the whole text and a linear
softmax gives the language. Both layers are trained by stochastic gradient
descent in numpy on a sample of at most ``PER_LANGUAGE`` different labelled texts of
each language, and ``SAMPLE`` in all, chosen by a hash. A tenth of the sample is kept apart to fit the
softmax temperature and the rejection level: a text whose calibrated score is
below the level that ``KEEP`` of the right answers reach is marked rejected.
Scoring reads whole texts and is one map over the documents.

Defined results: a null text or one without a letter is ``und`` with score 0 and
rejected, as is every text when there is nothing to learn from. Equal texts get
equal results; ties between languages go to the first in alphabetical order. Texts of
any length are read whole; columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.arrays import FOLD, chunks, text_bytes

SIZES = (2, 3, 4)
BUCKETS = 1 << 14
DIMENSIONS = 16
PER_LANGUAGE = 1200
SAMPLE = 50_000  # texts of all languages together
EPOCHS = 4
BATCH = 16
RATE = 4.0
KEEP = 0.995
UNKNOWN = "und"


def subwords(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each subword size: the bucket of the run that starts at each byte of the column, and the
    first and last+1 start of every row's runs (equal where a text is shorter than a run)."""
    raw, offsets = text_bytes(texts)
    raw = FOLD[raw].astype(np.uint32)
    key = raw.copy()
    for size in range(2, max(SIZES) + 1):
        key[:max(len(raw) - size + 1, 0)] |= raw[size - 1:] << np.uint32(8 * (size - 1))
        if size in SIZES:
            bucket = (key ^ np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
            bucket ^= bucket >> np.uint32(15)
            bucket *= np.uint32(0x2C1B3C6D)
            yield bucket >> np.uint32(18), np.stack([offsets[:-1], np.maximum(offsets[1:] - size + 1, offsets[:-1])])


def row_sums(values: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Sums over each [first, last) span; an empty span sums to zero."""
    first, last = spans
    full = np.flatnonzero(last > first)
    out = np.zeros((len(first), *values.shape[1:]))
    if len(full):
        cuts = np.stack([first[full], last[full]], axis=1).ravel()
        padded = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])
        out[full] = np.add.reduceat(padded, cuts, axis=0)[::2]
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket x language: what one subword adds to the logits
    bias: np.ndarray
    temperature: float = 1.0
    level: float = 0.0

    def logits(self, texts: pa.Array) -> np.ndarray:
        total = np.zeros((len(texts), len(self.languages)))
        n = np.zeros(len(texts))
        for bucket, spans in subwords(texts):
            for c, column in enumerate(self.table.T.copy()):
                total[:, c] += row_sums(column[bucket], spans)
            n += spans[1] - spans[0]
        return total / np.maximum(n, 1)[:, None] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def features(docs: DataFrame) -> list:
    """The sample's (lang, buckets, weights); a row holds at most one weight per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, part in chunks(b.column(1)):
                found = list(subwords(part))
                for i in range(len(part)):
                    every = np.concatenate([k[o[0, i]:o[1, i]] for k, o in found])
                    bucket, n = np.unique(every, return_counts=True)
                    if len(bucket):
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).slice(first + i, 1),
                             pa.array([bucket.astype("<u2").tobytes()], pa.binary()),
                             pa.array([(n / n.sum()).astype("<f4").tobytes()], pa.binary())],
                            ["lang", "buckets", "weights"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, buckets binary, weights binary").collect()


def sample_keys(rows: DataFrame, per_language: int, total: int = SAMPLE) -> DataFrame:
    """At most ``per_language`` different (lang, key) of each language and ``total`` in all, by smallest hash.

    Copies of a text have one key, so a hot text is taken once. Only keys under some four
    times the wanted share of the hash range are ranked, so the ranking stays as small as
    the sample however many texts a language has.
    """
    keys = rows.distinct()
    sizes = {r["lang"]: r["n"] for r in keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return keys
    wanted = max(1, min(per_language, total // len(sizes)))
    bound = F.create_map(*[F.lit(x) for k, n in sizes.items()
                           for x in (k, int(min(1.0, 4 * (wanted + 25) / n) * (1 << 31)))])
    spot = F.col("key").bitwiseAND(F.lit((1 << 31) - 1))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(spot, "key"))
    return (keys.where(spot < F.element_at(bound, F.col("lang")))
            .withColumn("_rank", rank).where(F.col("_rank") <= wanted).drop("_rank"))


def learn(labelled: DataFrame, lang: str = "lang", text: str = "text", per_language: int = PER_LANGUAGE,
          seed: int = 7) -> Model | None:
    """Train on a hash sample of ``labelled``; None if it holds no text with a language."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where(
        "lang is not null and text is not null").withColumn("key", F.xxhash64("text", "lang"))
    picked = rows.join(F.broadcast(sample_keys(rows.select("lang", "key"), per_language)), ["lang", "key"]) \
        .dropDuplicates(["lang", "key"])
    found = features(picked)
    languages = sorted({r["lang"] for r in found})
    if not languages:
        return None
    data = sorted(((languages.index(r["lang"]), np.frombuffer(r["buckets"], "<u2").astype(np.int64),
                    np.frombuffer(r["weights"], "<f4")) for r in found), key=lambda d: (d[0], d[1].tobytes()))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(data))
    held = order[:len(data) // 10]
    model = descend([data[i] for i in order[len(held):]], languages, rng)
    return calibrate(model, [data[i] for i in held])


def descend(data: list, languages: list[str], rng: np.random.Generator) -> Model:
    """Stochastic gradient descent over both layers, the rate falling to zero."""
    embed = rng.uniform(-0.5, 0.5, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    weight = rng.normal(0, 0.1, (DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    steps, done = EPOCHS * -(-len(data) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for at in range(0, len(data), BATCH):
            batch = [data[i] for i in order[at:at + BATCH]]
            rate = RATE * (1 - done / steps)
            done += 1
            bucket = np.concatenate([d[1] for d in batch])
            share = np.concatenate([d[2] for d in batch])[:, None]
            row = np.repeat(np.arange(len(batch)), [len(d[1]) for d in batch])
            ends = np.cumsum([len(d[1]) for d in batch])
            hidden = np.add.reduceat(embed[bucket] * share, np.append(0, ends[:-1]), axis=0)
            error = softmax(hidden @ weight + bias)
            error[np.arange(len(batch)), [d[0] for d in batch]] -= 1
            back = error @ weight.T
            weight -= rate / len(batch) * hidden.T @ error
            bias -= rate / len(batch) * 0.1 * error.sum(axis=0)
            # an embedding moves by its share of the text; sums over the batch, as each touches few
            pull = -rate * 10 * share * back[row]
            for d in range(DIMENSIONS):
                embed[:, d] += np.bincount(bucket, pull[:, d], minlength=BUCKETS)
    return Model(languages, (embed @ weight).astype(np.float32), bias)


def calibrate(model: Model, held: list) -> Model:
    """Temperature of the least log loss and the rejection level, from texts kept apart."""
    if not held:
        return model
    logits = np.stack([(model.table[b] * w[:, None]).sum(axis=0) + model.bias for _, b, w in held])
    truth = np.array([d[0] for d in held])
    rows = np.arange(len(held))

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / t)[rows, truth], 1e-12)).mean()

    model.temperature = float(min(np.geomspace(0.2, 5, 41), key=loss))
    p = model.probabilities(logits)
    right = p[rows, p.argmax(axis=1)][p.argmax(axis=1) == truth]
    model.level = float(np.quantile(right, 1 - KEEP)) if len(right) else 0.0
    return model


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` plus lang_pred, score (calibrated, 0 to 1) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for first, part in chunks(b.column(at)):
                lang, score = [UNKNOWN] * len(part), np.zeros(len(part))
                if m is not None:
                    p = m.probabilities(m.logits(part))
                    best = p.argmax(axis=1)
                    for i, t in enumerate(part.to_pylist()):
                        if t and any(map(str.isalpha, t)):
                            lang[i], score[i] = m.languages[best[i]], p[i, best[i]]
                level = m.level if m else 0.0
                rejected = [x == UNKNOWN or s < level for x, s in zip(lang, score)]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i).slice(first, len(part)) for i in range(len(names))),
                     pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                    [*names, "lang_pred", "score", "rejected"])

    schema = docs.select(*names).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.select(*names).mapInArrow(run, schema)


def identify(docs: DataFrame, held_out: Column, lang: str = "lang", text: str = "text") -> DataFrame:
    """Learn from the labelled rows that are not held out and predict every row."""
    marked = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return predict(marked, learn(marked.where("not held_out"), lang, text), text)
