"""Boilerplate lines: what the rule takes from texts, on hosts of any size and on awkward rows."""

import random
from collections import Counter

import pytest

from tidewater.llm import queries, quality_rules

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, source string, n_chars long, text string, lost string, _row int"


def brute(rows, min_docs=10, max_removed=30, judge=True):
    """(doc_id, source, n_chars, text) of what stays, by loops."""
    def norm(line):
        return line.strip(" \t\n\x0b\f\r").lower()

    holders = {}
    for doc, source, _, text in rows:
        for line in {norm(x) for x in (text or "").split("\n")} - {""}:
            holders.setdefault((source, line), {}).setdefault(text, set()).add(-1 if doc is None else doc)
    out = []
    for doc, source, chars, text in rows:
        lines = {norm(x) for x in (text or "").split("\n")} - {""}
        gone = {x for x in lines if len(holders[source, x]) > min_docs
                and min(holders[source, x], key=lambda t: min(holders[source, x][t])) != text}
        words = (text or "").split()
        wins = Counter(zip(words, words[1:], words[2:]))
        repeated = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if wins[w] > 1 for k in range(3)}
        if judge and (len(words) < 50 or 2 * len(repeated) > len(words) or 100 * sum(map(len, gone)) > max_removed * sum(map(len, lines))):
            continue
        if gone:
            text = "\n".join(x for x in text.split("\n") if norm(x) not in gone)
            chars = len(text)
        out.append((doc, source, chars, text))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    notes = [f"Shared NOTICE number {i} of this host" for i in range(4)]
    out = []
    for i in range(400):
        own = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) for _ in range(rng.choice([1, 3, 4]))]
        lines = own + rng.sample(notes, rng.randrange(4)) * rng.choice([1, 1, 9])
        rng.shuffle(lines)
        text = "\n".join(x + rng.choice(["", " ", "\t"]) for x in lines)
        out.append((i, rng.choice(["hot", "hot", "hot", "small", None]), len(text), text))
    extra = [(401, "hot", 0, None), (402, "hot", 0, ""), (None, None, 3, " \t "), out[7], out[7],
             (403, "hot", 9, "\n".join(notes))]
    return out + extra


def test_lines_and_documents_equal_brute_force(spark, rows):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = quality_rules.keep_documents(docs)
    assert got.columns == docs.columns
    assert sorted((tuple(r)[:4] for r in got.collect()), key=repr) == brute(rows)
    got = quality_rules.clean_lines(docs)
    assert sorted((tuple(r)[:4] for r in got.collect()), key=repr) == brute(rows, judge=False)
    assert len(brute(rows)) < len(brute(rows, judge=False)) == len(rows)
    assert any("Shared" not in (r[3] or "Shared") for r in brute(rows))


def test_limit_does_not_depend_on_the_size_of_the_host(spark, rows):
    """More documents on a host free no line of its limit."""
    filler = [(1000 + i, "hot", 5, f"other {i}") for i in range(2000)]
    docs = spark.createDataFrame([(*r, "", 0) for r in rows + filler], SCHEMA)
    kept = {r.doc_id for r in quality_rules.keep_documents(docs).collect()}
    assert kept == {r[0] for r in brute(rows)}


def test_empty_table(spark, rows):
    docs = spark.createDataFrame([(*r, "", 0) for r in rows[:3]], SCHEMA).limit(0)
    assert quality_rules.keep_documents(docs).count() == quality_rules.clean_lines(docs).count() == 0


def test_rule_decides_on_the_given_tables(spark):
    got = queries.op7_quality_rules(spark, SF)
    assert got.where("not kept and not base_failed").count() > 0
