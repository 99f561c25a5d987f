"""Merkle manifest, source divergence and SentencePiece coding against brute force, and on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidewater.llm import divergence, merkle, queries, sentence_pieces

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"Wort{'abcdefghij'[i % 10]}{'klmnop'[i % 6]}" for i in range(400_000))  # 3 MB
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, tree string, rank int"
AWKWARD = [(1, "s", "en", 0, ""), (2, None, None, None, None), (3, "s", "en", 5, LONG), (3, "s", "en", 5, LONG),
           (None, "t", "de", 4, " \t "), (4, "s", "", 7, "Ab ñandú 🙂 ▁x\x00"), (5, "", None, 1, "Ab ab"),
           (6, "u", "zz", 1, "lone")]


@pytest.fixture(scope="module")
def awkward(spark):
    sentence_pieces_docs = spark.createDataFrame([(*r, "clash", "clash", 0) for r in AWKWARD], SCHEMA)
    queries.line_dedup.drop_repeated(sentence_pieces_docs.select("doc_id", "text")).count()  # sets the shared folder
    return sentence_pieces_docs


def lower(text):
    return text if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)


# Merkle manifest

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grow(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def brute_manifest(rows, tampered):
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        given = leaf((*r[:4], lower(r[4]))) if tampered(r[0]) else leaf(r)
        groups[r[2]].append((r[0], leaf(r), given))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: grow([g[1] for g in groups[x]]) for x in langs}
    top = grow([trees[x][-1][0] for x in langs]) if langs else []
    out = []
    for place, lang in enumerate(langs):
        for i, (doc, own, value) in enumerate(groups[lang]):
            siblings = []
            for tree, at in ((trees[lang], i), (top, place)):
                for nodes in tree[:-1]:
                    run = nodes[at - at % 8:at - at % 8 + 8]
                    siblings += run[:at % 8] + run[at % 8 + 1:]
                    run[at % 8] = value
                    value, at = digest(*run), at // 8
            out.append((doc, own, trees[lang][-1][0], top[-1][0], digest(*siblings), value, value == top[-1][0]))
    return out


def by_key(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


def every_third(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0


def test_manifest_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*merkle.FIELDS).collect()]
    got = [tuple(r) for r in queries.op11_merkle_manifest(spark, SF).collect()]
    assert by_key(got) == by_key(brute_manifest(rows, every_third))
    assert {r[6] for r in got} == {True, False}


def test_manifest_over_several_tiers_and_many_groups(spark, awkward):
    """Subtrees of 8 rows: four tiers of rows and two of subroots, the last runs short or lone."""
    rows = [(i, f"s{i % 3}", "hot" if i < 1100 else f"l{i % 19}", i, f"Text {i}") for i in range(1200)]
    docs = spark.createDataFrame(rows, SCHEMA.split(", digest")[0])
    tampered = F.when(F.col("doc_id") % 7 == 0, merkle.leaf(*(
        merkle.lowered(F.col(f)) if f == "text" else F.col(f) for f in merkle.FIELDS)))
    got = [tuple(r)[:7] for r in merkle.manifest(docs, tampered, height=1).collect()]
    assert by_key(got) == by_key(brute_manifest(rows, lambda d: d % 7 == 0))


def test_manifest_of_awkward_and_empty_tables(spark, awkward):
    got = [tuple(r)[:7] for r in merkle.manifest(awkward).collect()]
    assert by_key(got) == by_key(brute_manifest(AWKWARD, lambda d: False))
    assert all(r[6] for r in got)
    assert merkle.manifest(awkward.limit(0)).count() == 0
    lone = merkle.manifest(awkward.where("doc_id = 6")).first()
    assert lone.leaf == lone.subroot == lone.root and lone.proof_sha256 == digest()


def test_parents_fold_from_retained_states():
    nodes = [digest(str(i)) for i in range(19)]
    parents = merkle.Parents(nodes)
    for at in range(19):
        run = nodes[at - at % 8:at - at % 8 + 8]
        run[at % 8] = digest("new")
        assert parents.fold(at, digest("new")) == digest(*run)
        assert parents.fold(at, nodes[at]) == parents.digests[at // 8]


# Source divergence

def brute_audit(rows, min_df, top=50):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for source, lang, text in rows:
        words = term.findall(lower(text or ""))
        docs[lang or ""].update(set(words))
        counts[lang or "", source or ""].update(words)
    out = []
    for lang, df in docs.items():
        kept = [t for t, n in df.items() if n >= min_df]
        own = {s: c for (x, s), c in counts.items() if x == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(sum(own.values(), Counter()))
        for s in own:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in own if o != s)
            most = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if own[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, item, -v, i) for part, found in (("pair", pairs), ("term", most))
                    for i, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def test_divergence_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("source", "lang", "text").collect()]
    got = sorted(map(tuple, queries.op12_source_divergence(spark, SF).collect()))
    assert got == brute_audit(rows, 30) and {r[2] for r in got} == {"pair", "term"}


def test_divergence_over_many_blocks(spark, awkward, monkeypatch):
    """Blocks of two sources and three terms, sources without terms, a language without kept terms."""
    monkeypatch.setattr(divergence, "SOURCES", 2)
    monkeypatch.setattr(divergence, "TERMS", 3)
    rng = random.Random(4)
    rows = [(f"s{rng.randrange(7)}", rng.choice(["en", "de", None, "a\x00b"]),
             " ".join(rng.choice("ABCdeéfghij") for _ in range(rng.randrange(8)))) for _ in range(160)]
    rows += [("empty", "en", None), ("empty", "en", "12 !"), ("x", "few", "A b"), ("y", "few", None)]
    docs = spark.createDataFrame(rows, "source string, lang string, text string")
    got = sorted(map(tuple, divergence.audit(docs, min_df=12, top=4).collect()))
    assert got == brute_audit(rows, 12, 4)
    assert [r[2:] for r in got if r[0] == "few"] == [("pair", "y", 0, 1), ("pair", "x", 0, 1)]


def test_divergence_of_awkward_and_empty_tables(spark, awkward):
    rows = [(r[1], r[2], r[4]) for r in AWKWARD]
    assert sorted(map(tuple, divergence.audit(awkward, min_df=1).collect())) == brute_audit(rows, 1)
    assert divergence.audit(awkward.limit(0)).count() == 0


# SentencePiece

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.Pieces(open(PIECES, "rb").read())


def test_pieces_equal_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_sentencepiece(spark, SF).collect()}
    ids = {d: library.encode(t, add_eos=True) for d, t in texts.items()}
    assert got == {d: (len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(),
                       hashlib.sha256(library.decode(i).encode()).hexdigest()) for d, i in ids.items()}


def test_pieces_of_odd_texts(library, model):
    rng = random.Random(1)
    letters = [*model.joined, *"   \n\t🙂éñ\x00▁ab"]
    parts = ["er", "in", "t", "th", "he", "a", "ing", "an", "n", "g", "s", "ss", " "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(5000)]
    texts += ["", " ", "▁", "a" * 3000, " " * 500, "ab" * 5000, "-=*" * 4000, "x" * 7 + " " * 33 + "y", LONG]
    want = library.encode(texts, add_eos=True)
    got = [np.frombuffer(x, "<u4").tolist() for x in model.encode(texts)]
    assert got == want
    assert [model.decode(w) for w in want] == [library.decode(w) for w in want]


def test_backtracking_takes_pieces_back(model):
    """Longest matches alone are wrong for some cuts; failed places lead back to the right pieces."""
    words = ["".join(p) for p in zip(*[iter(random.Random(2).choices("etaoinshrdlu", k=40_000))] * 8)]
    greedy = 0
    for w in words:
        out = model.backtracked(w)
        assert [model.text[i] for i in out] == model.merged(w)
        first = max((t for t in model.ids if w.startswith(t)), key=len) if greedy < 5 else ""
        greedy += bool(first) and first != model.text[out[0]]
    assert greedy == 5


def test_decoding_any_ids(library, model):
    rng = random.Random(3)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(300), rng.randrange(32_000)]) for _ in range(rng.randrange(12))]
        assert model.decode(ids) == library.decode(ids)


def test_pieces_of_awkward_and_empty_tables(spark, awkward, library):
    coded = sentence_pieces.encode(awkward, PIECES)
    got = sentence_pieces.decode(coded, PIECES, text="rank").collect()
    assert len(got) == len(AWKWARD) and coded.columns == [*awkward.columns, "ids"]
    for r in got:
        assert r.ids == library.encode(r.text or "", add_eos=True) and r["rank"] == library.decode(r.ids)
    nothing = awkward.select("doc_id", F.lit(None).cast("array<int>").alias("ids"))
    assert {r.text for r in sentence_pieces.decode(nothing, PIECES).collect()} == {""}
    assert sentence_pieces.encode(awkward.limit(0), PIECES).count() == 0


def test_terms_of_a_large_batch_are_cut_in_small_steps():
    import tracemalloc

    import pyarrow as pa
    texts = [f"Word{'x' * (i % 7)} other" * 400 for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de"] * 500), pa.array(["s"] * 1000), pa.array(texts)],
                                       ["lang", "source", "text"])
    whole = divergence.term_lists(batch.column(2), batch.column(0))
    tracemalloc.start()
    made, sizes = [], []
    for part in divergence.cut_terms(iter([batch])):
        made += part.column(2).to_pylist() if len(made) < 40 else [None] * part.num_rows
        sizes.append(part.num_rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == 1000 and len(sizes) > 4 and made[:40] == whole.to_pylist()[:40]
    assert peak < 70e6, peak


def test_sums_of_a_batch_travel_as_arrays(spark):
    """A row a group and range of term ids, not one a term; sums of several batches meet again."""
    from pyspark.ml.linalg import Vectors
    size = divergence.TERM_CELL + 10
    rows = [("en", f"s{i % 2}", Vectors.sparse(size, [(0, 2.0), (5, float(i)), (size - 1, 1.0)])) for i in range(6)]
    rows.append(("en", "none", Vectors.sparse(size, [])))
    vecs = spark.createDataFrame(rows, ["lang", "source", "vector"]).coalesce(1)
    parts = vecs.mapInArrow(divergence.partial_sums,
                            "lang string, source string, cell int, term_ids array<int>, counts array<long>").collect()
    assert sorted((r.source, r.cell, len(r.term_ids)) for r in parts) == [
        ("s0", 0, 2), ("s0", 1, 1), ("s1", 0, 2), ("s1", 1, 1)]
    got = {(r.source, r.term_id): r.n for r in divergence.group_counts(vecs.repartition(3)).collect()}
    assert got == {("s0", 0): 6, ("s0", 5): 6, ("s0", size - 1): 3, ("s1", 0): 6, ("s1", 5): 9, ("s1", size - 1): 3}
