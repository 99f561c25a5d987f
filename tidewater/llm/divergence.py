"""Source divergence audit: how far the sources of a language differ in their use of terms.

A term is a run of ASCII letters and non-ASCII characters, A-Z lower-cased. Spark's
``CountVectorizer`` (``minDF``, largest integer ``vocabSize``) makes the exact sparse
vector of every document. Its terms carry their language, so one fit holds the vocabulary
of each language apart, document frequencies included, whatever the number of languages.
Vectors are summed per (language, source): per Arrow batch in the task, whose sums travel as arrays
of a range of term ids, then per group and range, so a hot source is summed from partial counts.

Pairs of sources are evaluated in blocks of ``SOURCES`` sources and ``TERMS`` terms of a
language. A block pair holds only terms that one of its sources uses; what all other
terms add to a distance is the same for each and added once. So no row is made per
(pair, term), and a task holds two blocks.

All arithmetic is on integers: smoothed shares are p = 1 + floor(SCALE * (count + PRIOR) /
(N + PRIOR * V)), N the count of a group over the language's V kept terms.

The vocabulary itself comes to the driver and is broadcast by CountVectorizer; it holds
terms of at least ``min_df`` documents of one language and does not grow with repetition.

Defined results: null text, language and source are empty; blank texts add to no count but
their group occurs; repeated rows count as documents of their own; equal values rank by
the item's UTF-8 bytes. A language without kept terms has pairs of value 0 and no terms; an empty
table has no rows. Texts of any length are taken whole. Columns of other names do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.arrays import FOLD, chunks, summed, text_bytes
from tidewater.llm.common import written

IS_TERM = np.zeros(256, bool)  # ASCII letters and the bytes of other characters
IS_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
MIN_DF = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP_TERMS = 50
LARGEST_INT = 2**31 - 1
MARK = "\x00"  # between language and term; no term holds it
STEP_BYTES = 1 << 20  # of text cut at once; the index arrays of a step take some thirty times that
TERM_CELL = 4096  # term ids whose sums of a group travel as one row
SOURCES = 128
TERMS = 1024


def term_lists(texts: pa.Array, langs: pa.Array) -> pa.Array:
    """The terms of each text, in order, each behind its language and ``MARK``.

    Terms are cut from the column's bytes at once: term bytes move up to make room for
    the prefixes, which are laid in language by language.
    """
    raw, offsets = text_bytes(texts)
    inside = IS_TERM[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])[:len(raw)]))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False)[:len(raw)])) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    codes = langs.dictionary_encode()
    prefixes = [(x + MARK).encode() for x in codes.dictionary.to_pylist()]
    code = codes.indices.to_numpy(zero_copy_only=False)[row] if len(row) else row
    room = np.array([len(x) for x in prefixes], np.int64)[code] if len(row) else row
    sizes = ends - starts
    bounds = np.concatenate([[0], np.cumsum(sizes + room)])
    data = np.empty(bounds[-1], np.uint8)
    data[np.arange(sizes.sum()) + np.repeat(np.cumsum(room), sizes)] = FOLD[raw[inside]]
    for i, prefix in enumerate(prefixes):
        at = bounds[:-1][code == i]
        for k, byte in enumerate(prefix):
            data[at + k] = byte
    words = pa.StringArray.from_buffers(len(row), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)), words)


def cut_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, part in chunks(b.column(2), STEP_BYTES):
            langs, sources = (b.column(i).slice(first, len(part)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([langs, sources, term_lists(part, langs)], ["lang", "source", "terms"])


def tagged_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, terms) of documents (lang, source, text)."""
    return docs.select("lang", "source", "text").mapInArrow(cut_terms, "lang string, source string, terms array<string>")


def vectors(docs: DataFrame, min_df: int) -> tuple[DataFrame, DataFrame]:
    """((lang, source, vector) of every document, (term_id, lang, term, place) of the vocabulary).

    Rows of a term of no language keep the vocabulary from being empty, which
    CountVectorizer refuses; no document holds it.
    """
    spark = docs.sparkSession
    tagged = tagged_terms(docs)
    blank = spark.range(min_df).select(F.lit("").alias("lang"), F.lit("").alias("source"),
                                       F.array(F.lit(MARK)).alias("terms"))
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df), vocabSize=LARGEST_INT) \
        .fit(tagged.select("terms").unionByName(blank.select("terms")))
    size: Counter[str] = Counter()
    names = []  # ``place`` numbers the terms of each language
    for i, word in enumerate(model.vocabulary):
        lang, term = word.rsplit(MARK, 1)
        if term:
            names.append((i, lang, term, size[lang]))
            size[lang] += 1
    vocabulary = spark.createDataFrame(names, "term_id int, lang string, term string, place int")
    return model.transform(tagged).select("lang", "source", "vector"), vocabulary


def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, cell, term_ids, counts): the sums of a batch's vectors, ``TERM_CELL`` term ids of a group a row."""
    for b in batches:
        keys = pa.table({"lang": b.column(0), "source": b.column(1)})
        groups = keys.group_by(["lang", "source"]).aggregate([])
        place = {(r["lang"], r["source"]): i for i, r in enumerate(groups.to_pylist())}
        rows = np.fromiter((place[k] for k in zip(b.column(0).to_pylist(), b.column(1).to_pylist())), np.int64)
        vec = pa.array(b.column(2)) if not isinstance(b.column(2), pa.ExtensionArray) else b.column(2).storage
        indices, values = vec.field("indices"), vec.field("values")
        sizes = pc.fill_null(pc.list_value_length(indices), 0).to_numpy(zero_copy_only=False)
        key, counts = summed(np.repeat(rows, sizes) << 32 | indices.flatten().to_numpy(zero_copy_only=False),
                             values.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
        if not len(key):
            continue
        cell = key // TERM_CELL
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        ends = pa.array(np.append(first, len(key)).astype(np.int32))
        picked = groups.take(pa.array(key[first] >> 32)).combine_chunks()
        yield from pa.table({
            "lang": picked["lang"], "source": picked["source"],
            "cell": pa.array(((key[first] & 0xFFFFFFFF) // TERM_CELL).astype(np.int32)),
            "term_ids": pa.ListArray.from_arrays(ends, pa.array((key & 0xFFFFFFFF).astype(np.int32))),
            "counts": pa.ListArray.from_arrays(ends, pa.array(counts))}).to_batches()


def cell_sums(key: tuple[pa.Scalar, ...], cell: pa.Table) -> pa.Table:
    """The rows of ``partial_sums`` of one cell as one row a term."""
    ids, sums = summed(cell["term_ids"].combine_chunks().flatten().to_numpy(),
                       cell["counts"].combine_chunks().flatten().to_numpy())
    lang, source = (pa.repeat(k, len(ids)) for k in key[:2])
    return pa.table({"lang": lang, "source": source, "term_id": pa.array(ids), "n": pa.array(sums)})


def group_counts(vecs: DataFrame) -> DataFrame:
    """(lang, source, term_id, n): the sums of the vectors of each group.

    What a batch adds to a group travels as arrays, not as a row a term.
    """
    cells = vecs.mapInArrow(partial_sums, "lang string, source string, cell int, term_ids array<int>, counts array<long>")
    return cells.groupBy("lang", "source", "cell").applyInArrow(
        cell_sums, "lang string, source string, term_id int, n long")


def share(count: Column, total: Column, kept: Column) -> Column:
    """Smoothed share of a count; null without kept terms. Decimals: the product outgrows 64 bits."""
    wide = "decimal(28,0)"
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(20,0)")
    return F.when(kept > 0, F.call_function("div", top.cast("decimal(30,0)"), (total + PRIOR * kept).cast(wide)) + 1)


def block_distances(key: tuple[pa.Scalar, ...], cell: pa.Table) -> pa.Table:
    """Distances of all pairs of one cell: two blocks of sources over one block of terms.

    ``cell`` has a row without ``place`` for every source, with its share of unused terms,
    and a row for each term that a source uses.
    """
    lang, _, first, second = (k.as_py() for k in key)
    place = cell["place"].to_numpy()
    block, names, p = cell["block"].to_numpy(), cell["source"].to_pylist(), cell["p"].to_numpy()
    size = cell["size"][0].as_py()
    used, column = np.unique(place[place >= 0], return_inverse=True)
    sides = []
    for side in sorted({first, second}):
        mine = block == side
        sources = sorted(names[i] for i in np.flatnonzero(mine & (place < 0)))
        row = {s: i for i, s in enumerate(sources)}
        unused = np.zeros(len(sources), np.int64)
        for i in np.flatnonzero(mine & (place < 0)):
            unused[row[names[i]]] = p[i]
        shares = np.repeat(unused[:, None], len(used), axis=1)
        at = np.flatnonzero(mine & (place >= 0))
        columns = column[mine[place >= 0]]
        shares[[row[names[i]] for i in at], columns] = p[at]
        sides.append((sources, unused, shares))
    (left, left_unused, left_shares), (right, right_unused, right_shares) = sides[0], sides[-1]
    out: dict[str, list] = {"source": [], "item": [], "value": []}
    for a, name in enumerate(left):
        value = np.abs(right_shares - left_shares[a]).sum(axis=1) \
            + (size - len(used)) * np.abs(right_unused - left_unused[a])
        for other, v in zip(right, value.tolist()):
            if first == second and other == name:
                continue
            out["source"] += [name] if first == second else [name, other]
            out["item"] += [other] if first == second else [other, name]
            out["value"] += [v] if first == second else [v, v]
    return pa.table({"lang": pa.array([lang] * len(out["value"]), pa.string()),
                     "source": pa.array(out["source"], pa.string()), "item": pa.array(out["item"], pa.string()),
                     "value": pa.array(out["value"], pa.int64())})


def audit(docs: DataFrame, min_df: int = MIN_DF, top: int = TOP_TERMS, lang: str = "lang",
          source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the language's other sources
    (part ``pair``) and the terms that a source uses most above its language (``term``)."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    vecs, vocabulary = vectors(docs, min_df)
    counts = written(group_counts(vecs), "term-counts")
    kept = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = written(docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
                     .join(kept, "lang", "left")
                     .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
                             F.coalesce("kept", F.lit(0)).alias("kept")), "term-groups")
    named = counts.join(vocabulary.drop("lang"), "term_id")
    shares = named.join(groups, ["lang", "source"]).withColumn(
        "p", share(F.col("n"), F.col("total"), F.col("kept")))

    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("kept").alias("lang_kept"),
                                       F.count(F.lit(1)).alias("sources"))
    in_lang = counts.groupBy("lang", "term_id").agg(F.sum("n").alias("n")).join(langs, "lang").select(
        "lang", "term_id", share(F.col("n"), F.col("lang_total"), F.col("lang_kept")).alias("q"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    most = (shares.join(in_lang, ["lang", "term_id"]).where(F.col("p") > F.col("q"))
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    (F.col("p") - F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top))

    blocks = F.ceil(F.col("sources") / SOURCES)
    own = F.pmod(F.xxhash64("source"), blocks).cast("int").alias("block")
    cells = F.greatest(F.lit(1), F.ceil(F.col("kept") / TERMS)).cast("int")
    with_blocks = groups.join(langs.select("lang", "sources"), "lang")
    nobody = with_blocks.select(
        "lang", "source", own, blocks.cast("int").alias("blocks"), F.lit(-1).alias("place"), "kept",
        F.coalesce(share(F.lit(0), F.col("total"), F.col("kept")), F.lit(0)).alias("p"),
        F.explode(F.sequence(F.lit(0), cells - 1)).alias("cell"))
    uses = shares.join(langs.select("lang", "sources"), "lang").select(
        "lang", "source", own, blocks.cast("int").alias("blocks"), "place", "kept", "p",
        F.floor(F.col("place") / TERMS).cast("int").alias("cell"))
    dealt = nobody.unionByName(uses).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "lang", "source", "block", "place", "p", "cell",
        F.greatest(F.lit(0), F.least(F.lit(TERMS), F.col("kept") - F.col("cell") * TERMS)).alias("size"),
        F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    parts = dealt.groupBy("lang", "cell", "first", "second").applyInArrow(
        block_distances, "lang string, source string, item string, value long")
    pairs = (parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(ranked)))
    return pairs.unionByName(most)
