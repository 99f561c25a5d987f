"""The streaming sink: batches whole and once, few files, upsert buckets, replay after a failure."""

import glob
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewater.operators import entities as ent
from tidewater.sinks import commit_log as log
from tidewater.sinks import tables as sk
from tidewater.streaming import stream as st


def _root():
    return os.path.join(tempfile.mkdtemp(prefix="tidewater-log-"), "out")


def _rows(spark, batch, n=10):
    return spark.range(batch * n, (batch + 1) * n).select(
        "id", (F.col("id") % 7).alias("k"), F.lit("2031-03-02").cast("date").alias("event_date"))


def _parquet(root, table):
    return glob.glob(os.path.join(root, table, "**", "*.parquet"), recursive=True)


def test_files_do_not_grow_with_batches(spark, monkeypatch):
    monkeypatch.setattr(log, "FAN", 3)
    monkeypatch.setattr(log, "LOG_SLOTS", 5)
    root, files = _root(), []
    for batch in range(20):
        assert log.commit(spark, root, batch, {"t": log.Append(_rows(spark, batch), ("k",))})
        files.append(len(_parquet(root, "t")))
        assert sorted(r.id for r in log.read(spark, root, "t").collect()) == list(range(10 * (batch + 1)))
    assert max(f.level for f in log.latest(spark, root).folders) == 2
    # two turns of names on each of the levels in use, one file a folder
    assert max(files) <= 3 * 2 * 3 and len(_parquet(root, "log")) <= 5


def test_replayed_batches_leave_the_same_rows(spark):
    root = _root()
    made = [log.commit(spark, root, batch, {"t": log.Append(_rows(spark, batch))}) for batch in (0, 1, 1, 0, 2)]
    assert made == [True, True, False, False, True]
    assert sorted(r.id for r in log.read(spark, root, "t").collect()) == list(range(30))


def test_tables_appear_together_or_not_at_all(spark):
    root = _root()
    log.commit(spark, root, 0, {"a": log.Append(_rows(spark, 0)), "b": log.Append(_rows(spark, 0))})

    def fail(staged):
        assert staged["a"].count() == 10
        raise RuntimeError("between the two")

    with pytest.raises(RuntimeError):
        log.commit(spark, root, 1, {"a": log.Append(_rows(spark, 1)), "b": fail})
    assert log.read(spark, root, "a").count() == log.read(spark, root, "b").count() == 10
    log.commit(spark, root, 1, {"a": log.Append(_rows(spark, 1)), "b": log.Append(_rows(spark, 1))})
    assert log.read(spark, root, "a").count() == log.read(spark, root, "b").count() == 20


def test_empty_batches_and_tables(spark):
    root = _root()
    assert log.read(spark, root, "t") is None and log.latest(spark, root).batch_id == -1
    log.commit(spark, root, 0, {})
    assert log.read(spark, root, "t") is None and log.latest(spark, root).batch_id == 0
    log.commit(spark, root, 1, {"t": log.Append(_rows(spark, 0).limit(0))})
    assert log.read(spark, root, "t").count() == 0
    log.commit(spark, root, 2, {"t": log.Append(_rows(spark, 0))})
    assert log.read(spark, root, "t").count() == 10


def _entities(spark, rows):
    df = spark.createDataFrame(rows, "entity_id string, timestamp string")
    return ent.derive_entities(df.select("entity_id", F.col("timestamp").cast("timestamp").alias("timestamp"),
                                         F.lit("mysql").alias("source"), F.lit("test").alias("environment")))


def test_upserts_rewrite_only_touched_buckets(spark):
    root = _root()
    names = [f"host-{i}" for i in range(2000)]
    put = lambda batch, rows: log.commit(spark, root, batch, {
        "entities": log.Upsert(_entities(spark, rows), "entity_id", ent.upsert_entities)})
    put(0, [(n, "2031-03-02 00:00:00") for n in names])
    before = {f: os.stat(f).st_mtime_ns for f in _parquet(root, "entities")}
    assert len(before) == log.BUCKETS
    for batch in range(1, 6):
        put(batch, [("host-7", f"2031-03-02 0{batch}:00:00")])
        after = _parquet(root, "entities")
        assert len(after) == log.BUCKETS + 1  # the touched bucket's other side, no more with further batches
    assert sum(os.path.exists(f) and os.stat(f).st_mtime_ns == t for f, t in before.items()) >= log.BUCKETS - 1
    got = {r.entity_id: r for r in log.read(spark, root, "entities").collect()}
    assert len(got) == 2000 and (got["host-7"].records, str(got["host-7"].last_seen)) == (6, "2031-03-02 05:00:00")
    assert str(got["host-7"].first_seen) == "2031-03-02 00:00:00" and got["host-8"].records == 1


def _messages(bronze, n):
    logs = [("raw-logs", json.dumps({"timestamp": f"2031-03-02T00:00:{i:02d}", "host": f"h{i % 3}", "payload": {}}))
            for i in range(n)]
    return bronze([*logs, ("otel-metrics", json.dumps({"scope_metrics": [{"metrics": [
        {"name": "m", "gauge": {"data_points": [{"as_int": str(i)} for i in range(n)]}}]}]})), ("raw-logs", "{")])


def test_a_batch_that_dies_between_events_and_metrics_is_replayed_once(spark, bronze, monkeypatch):
    """ST4: events are staged, the metrics write fails; after the restart every id is there once."""
    root, messages = _root(), _messages(bronze, 9)
    contract = sk.metrics_contract
    monkeypatch.setattr(sk, "metrics_contract", lambda m: contract(m).withColumn(
        "unit", F.raise_error(F.lit("the metrics write dies")).cast("string")))
    with pytest.raises(Exception, match="the metrics write dies"):
        st.normalise_batch(messages, 0, root)
    assert _parquet(root, "events") and log.read(spark, root, "events") is None  # staged, not visible
    monkeypatch.undo()
    assert st.normalise_batch(messages, 0, root)
    assert not st.normalise_batch(messages, 0, root)  # replayed after its commit
    for table, n in (("events", 9), ("metrics", 9), ("dead_letter", 1)):
        assert log.read(spark, root, table).count() == n
    assert log.read(spark, root, "events").select("id").distinct().count() == 9
    assert {r.entity_id: r.records for r in log.read(spark, root, "entities").collect()} == {
        "h0": 3, "h1": 3, "h2": 3, "unknown_host": 9}
    [stats] = log.read(spark, root, "batch_stats").collect()
    assert (stats.events, stats.metrics, stats.dead_letters, stats.is_empty) == (9, 9, 1, False)
