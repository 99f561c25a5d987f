"""Training-data operators against brute force, and on awkward rows."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewater.llm import (bpe, decontaminate, language_id, line_dedup, lm_scoring, near_duplicates,
                           quality_classifier, quality_rules, queries, token_files, url_filters)

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 997}x{i}" for i in range(6000))
AWKWARD = [(1, "", "en", "s"), (2, None, None, None), (3, LONG, "en", "s"), (3, LONG, "en", "s"),
           (4, "same line of more than twenty points\nother 1", "fr", "s"),
           (5, "same line of more than twenty points\nother 2", "fr", None),
           (6, "SAME line of more than twenty points \n\n", "fr", "s"), (None, " \t ", "de", "t"),
           (7, "one two", "en", "s"), (8, "²½ <|endoftext|> ñandú 🙂 \x1c don't", "es", "s")]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(*r, "clash", 0, "x") for r in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, key string, "
                                       "label int, win string")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_block_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 4096, 4097):
        for high in (1, 300, 50_257, 2**32 - 1):
            ids = rng.integers(0, high, n, dtype=np.uint32)
            ids[rng.random(n) < 0.05] = high
            assert (token_files.unpack(token_files.pack(ids)) == ids).all()


def test_bpe_and_token_files_equal_the_library(spark, texts):
    library = Tokenizer.from_file(VOCABULARY)
    ids = {d: library.encode(t, add_special_tokens=False).ids for d, t in texts.items()}
    raw = {d: np.array(i, "<u4").tobytes() for d, i in ids.items()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op2_bpe(spark, SF).collect()}
    assert got == {d: (len(i), hashlib.sha256(raw[d]).hexdigest(), hashlib.sha256(
        library.decode(i, skip_special_tokens=False).encode()).hexdigest()) for d, i in ids.items()}
    start, want = 0, {}
    for d in sorted(ids):
        want[d] = (start, len(ids[d]) + 1, zlib.crc32(raw[d] + bytes(4)))
        start += len(ids[d]) + 1
    assert {r.doc_id: tuple(r)[1:] for r in queries.op4_token_files(spark, SF).collect()} == want


def test_bpe_of_odd_texts_and_long_words():
    library = Tokenizer.from_file(VOCABULARY)
    encoder = bpe.Encoder(open(VOCABULARY).read())
    odd = ["", "x" * 3000 + "ñ" * 500, " " * 700, "-=" * 900, *(r[1] or "" for r in AWKWARD), "՘a ⅕ \x1d"]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(odd)] == [
        library.encode(t, add_special_tokens=False).ids for t in odd]


def test_lm_scoring_base_equals_brute_force(spark, texts):
    def tokens(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", t.encode().lower().decode()), None]

    count = Counter(w for d, t in texts.items() if zlib.crc32(str(d).encode()) % 5 != 1 for w in tokens(t))
    total, types = sum(count.values()), len(count)
    for r in queries.op9_lm_scoring(spark, SF).collect():
        words = tokens(texts[r.doc_id])
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (types + 1))) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(count[w] > 0 for w in words), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and -math.inf < r.score < 0


def test_language_id_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in queries.op8_language_id(spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.9 * len(held)


def test_near_duplicates_find_all_similar_pairs(spark, texts):
    sets = {}
    for d, t in texts.items():
        w = t.lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    found = {r.doc_id: r.class_id for r in queries.op3_near_duplicates(spark, SF).collect()}
    ids = sorted(texts)
    linked = set()
    for i, a in enumerate(ids):
        for b in ids[:i]:
            j = len(sets[a] & sets[b]) / max(len(sets[a] | sets[b]), 1)
            if j >= 0.85:
                assert found[a] == found[b]
            if j >= 0.7:
                linked |= {a, b}
    copies = Counter(texts.values())
    assert all(found[d] == d for d in ids if d not in linked and copies[texts[d]] == 1)


def test_quality_classifier_keeps_good_and_rejects_junk(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in queries.op1_quality_classifier(spark, sf).collect() if r.doc_id in labels]
    good = [r.kept for r in got if labels[r.doc_id].quality == 1 and not labels[r.doc_id].toxic]
    junk = [r.kept for r in got if labels[r.doc_id].quality == 0]
    assert sum(good) >= 0.9 * len(good) and sum(junk) <= 0.5 * len(junk)


def test_short_benchmark_items_and_spans(spark):
    docs = spark.createDataFrame([(1, "a b C d e f"), (2, "x y"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "B c"), (8, "zz"), (9, ""), (10, "e"), (11, "b c")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(docs, items).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].item_ids) == (6, 3, ["10", "11", "7"])
    assert [tuple(s) for s in got[1].spans] == [(1, 2), (4, 4)]
    assert not got[2].contaminated and got[3].n_words == 0


def test_url_rules_precedence(spark):
    pages = spark.createDataFrame([(1, "http://a.B.net/en/x"), (2, "https://b.net"), (3, None), (4, "b.net/en/"),
                                   (5, "http://xb.net/english"), (5, "http://xb.net/english")], "page_id int, url string")
    rules = spark.createDataFrame([("net", "/", "block"), ("b.net", "/en/", "allow"), ("net", "/eng", "allow")],
                                  "host string, path string, action string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in
                 url_filters.filter_urls(pages, rules).collect())
    assert got == [(1, "a.b.net", "/en/x", "b.net/en/", "allow"), (2, "b.net", "", None, "allow"),
                   (3, "", "", None, "allow"), (4, "", "", None, "allow"),
                   *[(5, "xb.net", "/english", "net/eng", "allow")] * 2]
    assert url_filters.filter_urls(pages, rules.limit(0)).where("verdict = 'allow'").count() == 6


def run_all(spark, docs):
    held = docs["doc_id"] % 3 == 0
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "one two"), (None, None)], "item_id long, text string")
    path = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"tokens-{os.urandom(4).hex()}")
    token_files.write_tokens(docs, path, VOCABULARY)
    return {
        "classifier": quality_classifier.classify(docs, labels), "bpe": bpe.decode(bpe.encode(
            docs, VOCABULARY), VOCABULARY, text="decoded"),
        "near": near_duplicates.classes(docs), "files": token_files.read_tokens(spark, path),
        "rules": quality_rules.judge(docs), "language": language_id.identify(docs, held),
        "lm": lm_scoring.score(docs, held), "lines": line_dedup.drop_repeated(docs)}, \
        decontaminate.contamination(docs, items)


def test_awkward_rows(spark, awkward):
    line_dedup.drop_repeated(awkward).count()  # sets the shared folder
    every, hits = run_all(spark, awkward)
    found = {name: df.collect() for name, df in every.items()}
    assert {n: len(r) for n, r in found.items()} == dict.fromkeys(found, len(AWKWARD))
    assert [r.text or "" for r in found["bpe"]] == [r.decoded for r in found["bpe"]]
    assert {r.doc_id: r.class_id for r in found["near"]}[3] == 3
    assert all(not r.kept for r in found["classifier"] if not r.n_bytes)
    assert {(r.doc_id, r.n_lines, r.n_dropped) for r in found["lines"]} >= {(4, 2, 1), (5, 2, 1), (6, 3, 0), (2, 1, 0)}
    assert {r.lang_pred for r in found["language"] if r.doc_id in (1, 2)} == {"und"}
    assert len(hits.collect()) == len({r[:2] for r in AWKWARD})
    assert near_duplicates.keep_one(awkward).count() == len(AWKWARD) - 1


def test_empty_table(spark, awkward):
    line_dedup.drop_repeated(awkward).count()
    every, hits = run_all(spark, awkward.limit(0))
    assert all(df.count() == 0 for df in every.values()) and hits.count() == 0


def test_pipeline_keeps_clean_documents_once(spark, texts):
    import corpus_pipeline
    kept = corpus_pipeline.run(spark, SF).collect()
    ids = [r.doc_id for r in kept]
    assert len(ids) == len(set(ids)) and all(r.round_trip for r in kept)
    base = {r.doc_id for r in queries.op7_quality_rules(spark, SF).collect() if r.kept}
    dirty = {r.doc_id for r in queries.op5_decontaminate(spark, SF).collect() if r.contaminated}
    classes = {r.doc_id: r.class_id for r in queries.op3_near_duplicates(spark, SF).collect()}
    alone = {d for d, n in Counter(classes[d] for d in base).items() if n == 1}
    assert set(ids) <= base
    assert {d for d in base - dirty if classes[d] in alone} <= set(ids)


def near_copies(rng, groups, copies, words=200):
    """Texts of one large group: all share most words, the copies of a group more."""
    base = [f"w{i}" for i in range(words)]
    out = []
    for g in range(groups):
        own = base[:176] + [f"g{g}x{i}" for i in range(24)]
        for c in range(copies):
            t = list(own)
            for at in rng.choice(170, 4 * (c > 0), replace=False):
                t[at] = f"c{g}y{c}z{at}"
            out.append(" ".join(t))
    return out


def weighted_jaccard(a, b):
    low = sum((a & b).values())
    return low / (sum(a.values()) + sum(b.values()) - low)


def test_near_duplicates_of_split_buckets_all_meet(spark, monkeypatch):
    """Buckets of many blocks of one text or a few: every similar pair must still end in one class."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 1)
    monkeypatch.setattr(near_duplicates, "IDF_GAIN", 0.0)  # weights are counts
    texts = near_copies(np.random.default_rng(5), 100, 2)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    near_duplicates.written(docs, "first")  # sets the shared folder
    found = {r.doc_id: r.class_id for r in near_duplicates.classes(docs).collect()}
    bags = []
    for t in texts:
        w = t.split()
        bags.append(Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)))
    similar = [(i, j) for i in range(len(texts)) for j in range(i) if weighted_jaccard(bags[i], bags[j]) >= 0.8]
    assert len(similar) >= 90
    assert [(i, j) for i, j in similar if found[i] != found[j]] == []


def test_near_duplicates_of_heavy_shingles_and_null_ids(spark):
    """A shingle of more than 65,504 repeats, and texts that only have rows without an id."""
    heavy = "a " * 70_000
    words = [f"n{i}" for i in range(300)]
    rows = [(1, heavy + "b"), (2, heavy + "c"), (None, " ".join(words)), (None, " ".join(words)),
            (7, " ".join(words[:299]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near_duplicates.written(docs, "first")  # sets the shared folder
    found = sorted((r.class_id or 0, r.doc_id or 0) for r in near_duplicates.classes(docs).collect())
    assert found == [(1, 1), (1, 2), (7, 0), (7, 0), (7, 7)]


def test_lm_scoring_counts_rare_ngrams(spark, texts, monkeypatch):
    """No n-gram is too rare for the filter: scores follow brute-force levels of all counts."""
    monkeypatch.setattr(lm_scoring, "MIN_SHARE", 1e-3, raising=False)

    def tokens(t):
        return [None, *re.findall(r"[^\x20\x09-\x0D]+", t.encode().lower().decode()), None]

    def middle(count):
        return (3 * 2 ** (count.bit_length() - 1) - 1) / 2 if count else 0.0

    seqs = {d: tokens(t) for d, t in texts.items()}
    trained = [s for d, s in seqs.items() if zlib.crc32(str(d).encode()) % 5 != 1]
    one, two = Counter(w for s in trained for w in s[1:]), Counter(p for s in trained for p in zip(s, s[1:]))
    size = sum(one.values()) + 0.5 * (len(one) + 1)
    got, want = [], []
    for r in queries.op9_lm_scoring(spark, SF).collect():
        p = 0.0
        for c, w in zip(seqs[r.doc_id], seqs[r.doc_id][1:]):
            before, rest = middle(one[c]), (middle(one[w]) + 0.5) / size
            p += math.log10(0.6 * min(middle(two[c, w]) / before, 1.0) + 0.4 * rest if before else rest)
        got.append(r.score / r.n_tokens)
        want.append(p / r.n_tokens)
    error = np.abs(np.array(got) - np.array(want))
    assert np.median(error) < 0.05  # the filter's false positives


def test_language_id_subwords_of_short_chunks():
    for text, runs in (("", [0, 0, 0]), ("a", [0, 0, 0]), ("ab", [1, 0, 0]), ("abc", [2, 1, 0]), ("abcd", [3, 2, 1])):
        assert [int((o[1] - o[0]).sum()) for _, o in language_id.subwords(pa.array([text]))] == runs


def test_language_id_sample_is_bounded_whatever_the_copies(spark):
    """A hot text counts once, a language gives no more than its share, languages share the total."""
    rows = [("hot copy of a text", "en")] * 3000 + [(f"text {i}", "en") for i in range(3000)] + \
        [(f"texte {i}", "fr") for i in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    keyed = docs.select("lang", language_id.F.xxhash64("text", "lang").alias("key"))
    for total, want in ((50_000, {"en": 100, "fr": 40}), (60, {"en": 30, "fr": 30})):
        got = Counter(r.lang for r in language_id.sample_keys(keyed, 100, total).collect())
        assert got == want
    assert language_id.sample_keys(keyed.limit(0), 100).count() == 0


def test_distinct_keys_are_sorted_and_each_once():
    from tidewater.llm.arrays import distinct
    keys = np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    for a in (keys, np.repeat(keys, 3), keys[:1], keys[:0], np.array([2**64 - 1, 0, 2**64 - 1], np.uint64)):
        assert distinct(a).tolist() == sorted(set(a.tolist()))


def test_word_table_looks_older_words_up_and_drops_the_oldest(monkeypatch):
    monkeypatch.setattr(token_files, "TABLE_WORDS", 3)
    text = open(queries.VOCABULARY).read()
    library, encoder = Tokenizer.from_str(text), token_files.LibraryEncoder(text)
    texts = ["a b c d", "a\x7f b", "d e f\tg h", " a é <|endoftext|> x", "", "\x1c~!  \n"] * 2
    for t in texts:
        assert np.frombuffer(encoder.encode([t])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
        assert isinstance(encoder.words, token_files.Words) and len(getattr(encoder.words.older, "older", ())) == 0


def test_ascii_texts_split_as_by_the_class_pattern():
    rng = np.random.default_rng(3)
    letters = [c for c in map(chr, range(128)) if not bpe.CONTROL.match(c)] + list(" \t\n'_sd1") * 9
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(0, 16)))
        assert bpe.QUICK_ASCII.findall(text) == bpe.QUICK.findall(text) == bpe.split_words(text)
