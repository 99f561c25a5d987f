"""The classifier trains on every trusted document that does not calibrate, however many there are."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import line_dedup, quality_classifier as qc


@pytest.fixture(scope="module")
def counted(spark):
    line_dedup.drop_repeated(spark.createDataFrame([(1, "a")], "doc_id long, text string")).count()  # sets the shared folder
    seen = {}
    score, count = qc.score, qc.count_ngrams

    def scored(docs, trusted, *rest):
        seen["ids"] = {r.doc_id for r in trusted.collect()}
        return score(docs, trusted, *rest)

    def counts(texts):
        seen["texts"] = sorted(r.text for r in texts.collect())
        out = count(texts).localCheckpoint()
        seen["ngrams"] = sum(int(qc.unpack_numbers(r.counts).sum()) for r in out.collect())
        return out

    with pytest.MonkeyPatch.context() as m:
        m.setattr(qc, "score", scored)
        m.setattr(qc, "count_ngrams", counts)
        m.setattr(qc, "PENDING", 1 << 12)
        # ids 0..39,999 are trusted, the next 20,000 are not; every 1,000th row comes twice, and some ids are null
        docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"))
        docs = docs.unionByName(docs.where("doc_id % 1000 = 0")).unionByName(docs.limit(5).withColumn("doc_id", F.lit(None).cast("long")))
        labels = spark.range(60_000).select(F.col("id").alias("doc_id"), (F.col("id") < 40_000).cast("int").alias("quality"), F.lit(0).alias("toxic"))
        seen["rows"] = qc.classify(docs, labels).count()
    return seen


def test_all_trusted_documents_but_the_calibrating_share_train(counted):
    assert abs(len(counted["ids"]) - 0.7 * 40_000) < 500 and max(counted["ids"]) < 40_000
    want = sorted(f"text {i}" for i in counted["ids"] for _ in range(2 if i % 1000 == 0 else 1))
    assert counted["texts"] == want and counted["ngrams"] == sum(map(len, want))
    assert counted["rows"] == 60_065


def test_rows_are_found_by_ids_of_another_type_too(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "doc_id int, text string")
    for kind in ("int", "long"):
        ids = spark.createDataFrame([(2,), (7,)], f"doc_id {kind}")
        assert sorted(r.text for r in qc.only_ids(rows, ids).collect()) == ["b", "c"]
        assert qc.only_ids(rows, ids.limit(0)).count() == 0


def test_sums_of_parts_are_those_of_the_whole(monkeypatch):
    monkeypatch.setattr(qc, "PENDING", 10)
    rng = np.random.default_rng(3)
    parts = [np.unique(rng.integers(0, 50, n).astype(np.uint64), return_counts=True) for n in (7, 0, 30, 1, 90)]
    keys, counts = qc.folded(parts)
    want = np.zeros(50, np.int64)
    for k, c in parts:
        want[k.astype(int)] += c
    assert (keys == np.flatnonzero(want)).all() and (counts == want[want > 0]).all()
    assert len(qc.folded([])[0]) == 0
