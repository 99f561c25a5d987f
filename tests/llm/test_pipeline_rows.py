"""The whole pipeline row by row against a brute-force chain of its five stages, and on an empty table."""

import os
import random
import re
import tempfile
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_quality_lines import brute as quality_stage
from tokenizers import Tokenizer

SPACES = " \t\n\x0b\f\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def line_stage(rows):
    def key(line):
        return lower(line.strip(SPACES))

    holders = {}
    for doc, _, _, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, source, chars, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 3 or doc == max(holders[key(x)])]
        out.append((doc, source, chars, text) if len(kept) == len(lines)
                   else (doc, source, len("\n".join(kept)), "\n".join(kept)))
    return out


def near_stage(rows):
    def shingles(text):
        words = lower(text or "").split()
        return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else None

    bags, parent = [shingles(r[3]) for r in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            alike = rows[i][3] == rows[j][3]
            if a and b and not alike:
                low = sum((a & b).values())
                alike = low >= 0.8 * (sum(a.values()) + sum(b.values()) - low)
            if alike:
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r), r, key=lambda x: x[0])
    return list(least.values())


def clean_stage(rows, items):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))

    bad = {tuple(w[i:i + 10]) for w in map(words, items) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(x) for x in bad}
    return [r for r in rows if not any(tuple(w[i:i + n]) in bad for w in [words(r[3])]
                                       for n in sizes for i in range(len(w) - n + 1))]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(10**7)}"
    line = lambda n: " ".join(word() for _ in range(n))
    passage, notice, license_ = line(30), "Notice of this host " + line(3), "Shared by some only " + line(8)
    texts = ["\n".join(line(rng.randrange(8, 20)) for _ in range(rng.randrange(5, 9))) for _ in range(90)]
    for i in range(0, 14):
        texts[i] += "\n" + notice
    for i in range(20, 24):
        texts[i] = license_ + "\n" + texts[i]
    for i in range(30, 34):
        texts[i] += "\n" + passage.upper()
    for i in range(40, 50):  # near copies: one word of another text changed
        other = texts[i + 10].split(" ")
        other[3] = word()
        texts[i] = " ".join(other)
    texts[60:63] = [texts[60]] * 3  # three copies lose their lines but in the last
    texts[64] = texts[63]
    foreign = "Ñandú 🙂 " * 3 + texts[71][::-1]
    rows = [(i, t, "en", "hot" if i % 3 else "small", len(t)) for i, t in enumerate(texts)]
    rows += [(200, None, None, None, None), (201, "", "en", "hot", 0), (202, "too short", "en", "hot", 9), rows[70],
             (203, foreign, "es", None, len(foreign))]
    return rows, [passage, None, "", "some words of an item that never occurs anywhere in any text"]


def run(spark, rows, items):
    import corpus_pipeline
    folder = tempfile.mkdtemp(prefix="tidewater-pipeline-")
    spark.createDataFrame(rows, DOCS).write.parquet(os.path.join(folder, "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(
        os.path.join(folder, "benchmark.parquet"))
    return corpus_pipeline.run(spark, folder)


def test_pipeline_rows_equal_the_brute_force_chain(spark, rows):
    docs, items = rows
    kept = quality_stage([(d, s, n, t) for d, t, _, s, n in docs])
    want = clean_stage(near_stage(line_stage(kept)), items)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in run(spark, docs, items).collect()}
    assert sorted(got) == sorted(r[0] for r in want)
    for doc, source, chars, text in want:
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = got[doc]
        assert (r.text, r.source, r.n_chars) == (text, source, chars)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids) and r.round_trip
    changed = {d for d, t, *_ in docs if d in got and got[d].text != t}
    assert changed and len(got) < len({d for d, *_ in docs}) - 10


def test_pipeline_of_an_empty_table(spark, rows):
    got = run(spark, [], rows[1])
    assert got.count() == 0 and {"doc_id", "text", "ids", "n_tokens", "round_trip"} <= set(got.columns)
