"""Large JSON documents cut at their elements: any content, any split, ids that stay."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewater.sources import documents, files
from tidewater.sinks import lifecycle


def _write(values, indent=None):
    d = tempfile.mkdtemp(prefix="tidewater-docs-")
    for i, v in enumerate(values):
        with open(os.path.join(d, f"{i}.json"), "w") as f:
            f.write(v if isinstance(v, str) else json.dumps(v, indent=indent, ensure_ascii=False))
    return d


def _odd(rng, depth=0):
    """A random JSON value full of brackets, quotes, commas and backslashes inside strings."""
    kind = rng.randrange(6 if depth < 3 else 3)
    if kind < 2:
        return "".join(rng.choice('a,"\\[]{}é🙂 \n') for _ in range(rng.randrange(12)))
    if kind == 2:
        return rng.choice([1, -2.5, None, True])
    return [_odd(rng, depth + 1) for _ in range(rng.randrange(4))] if kind == 3 else {
        str(_odd(rng, 9)) if rng.random() < 0.5 else "k": _odd(rng, depth + 1) for _ in range(rng.randrange(4))} \
        if kind == 4 else {"a": [_odd(rng, depth + 1)]}


@pytest.mark.parametrize("indent", [None, 2])
def test_elements_equal_the_parsed_array_whatever_the_splits(spark, indent):
    rng = random.Random(8)
    docs = [[{"n": i, "v": {str(k): _odd(rng) for k in range(3)}} for i in range(60)] for _ in range(3)]
    # an object, nothing, blanks, an element longer than a split
    docs += [{"one": [1, 2, "a,b"]}, [], "", " \n[ ] \n", [{"long": "x,[" * 4000}, {"n": 1}]]
    path = _write(docs, indent)
    want = sorted(json.dumps(e, sort_keys=True) for d in docs if not isinstance(d, str)
                  for e in (d if isinstance(d, list) else [d]))
    seen = []
    for size in ("128m", "1500b", "311b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = documents.read_elements(spark, path).collect()
            tasks = spark.read.option("lineSep", ",").text(path).rdd.getNumPartitions()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert size == "128m" or tasks > 20
        assert sorted(json.dumps(json.loads(r.text), sort_keys=True) for r in rows) == want
        seen.append(sorted((r.path, r.element) for r in rows))
    assert seen[0] == seen[1] == seen[2] and len(set(seen[0])) == len(seen[0])


def test_equal_elements_are_different_messages(spark):
    path = _write([[{"a": 1}] * 5, "[1, 2"])
    rows = files.read_json_documents(spark, path, "raw-logs").collect()
    assert len({(r.partition, r.offset) for r in rows}) == len(rows) == 7
    assert sorted(r.value for r in rows) == ["1", "2"] + ['{"a": 1}'] * 5


def test_known_ids_read_only_their_days(spark):
    """SK11: partitions without a new row's day are not read."""
    d = os.path.join(tempfile.mkdtemp(prefix="tidewater-ids-"), "t")
    rows = spark.range(400).select(F.col("id").cast("string").alias("id"),
                                   F.date_add(F.lit("2031-03-01").cast("date"), (F.col("id") % 10).cast("int")).alias("event_date"))
    rows.write.partitionBy("event_date").parquet(d)
    new = rows.where("id in ('3', '13')").unionByName(
        spark.createDataFrame([("n1",), ("n1",), ("n2",)], "id string").withColumn("event_date", F.lit("2031-03-04").cast("date")))
    out = lifecycle.absent_rows(spark.read.parquet(d), new)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "PartitionFilters: [event_date" in plan
    assert sorted(r.id for r in out.collect()) == ["n1", "n2"]
