"""Streaming: restart from the checkpoint (ST4), batch counts (AG9), entity catalogue (ST10)."""

import glob
import json
import os
import tempfile

from pyspark.sql import functions as F

from tidewater.sinks import commit_log as log
from tidewater.sources import files
from tidewater.streaming import stream as st


def _land(spark, path, rows, first_offset):
    df = spark.createDataFrame(
        [(t, 0, first_offset + i, None, v) for i, (t, v) in enumerate(rows)],
        "topic STRING, `partition` INT, `offset` BIGINT, key STRING, value STRING")
    df = df.withColumn("ingest_ts", F.lit("2025-01-01 00:00:00").cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(path)


def _log(host, i):
    return ("raw-logs", json.dumps({"timestamp": f"2025-01-01T00:00:{i:02d}", "host": host,
                                    "tags": {"log_level": "error"}, "payload": {"event_type": "deadlocks"}}))


def test_restart_processes_only_new_input(spark):
    base = tempfile.mkdtemp(prefix="tidewater-stream-")
    bronze, out, ckpt = (os.path.join(base, d) for d in ("bronze", "out", "ckpt"))
    _land(spark, bronze, [_log("a", i) for i in range(5)] + [("raw-logs", "{bad")], 0)
    st.start_normalisation(files.read_messages_stream(spark, bronze), out, ckpt,
                           available_now=True).awaitTermination()
    _land(spark, bronze, [_log("b", i) for i in range(3)], 100)
    # restart on the same checkpoint: only the new file is read
    st.start_normalisation(files.read_messages_stream(spark, bronze), out, ckpt,
                           available_now=True).awaitTermination()
    ev = log.read(spark, out, "events")
    assert ev.count() == 8
    assert ev.select("id").distinct().count() == 8
    assert log.read(spark, out, "dead_letter").count() == 1
    stats = log.read(spark, out, "batch_stats")
    assert stats.agg(F.sum("events"), F.sum("dead_letters")).collect()[0][:] == (8, 1)
    assert stats.where("is_empty").count() == 0
    ent = log.read(spark, out, "entities")
    got = {r.entity_id: r.records for r in ent.collect()}
    assert got == {"a": 5, "b": 3}


def test_processing_time_trigger_with_size_bound(spark):
    """ST2: age trigger (processingTime) with the batch size bounded by files per trigger."""
    from tidewater.operators.processor import ProcessorConfig
    base = tempfile.mkdtemp(prefix="tidewater-stream-")
    bronze, out, ckpt = (os.path.join(base, d) for d in ("bronze", "out", "ckpt"))
    for k in range(3):
        _land(spark, bronze, [_log(f"h{k}", i) for i in range(2)], 10 * k)
    q = st.start_normalisation(files.read_messages_stream(spark, bronze, max_files_per_trigger=1), out, ckpt,
                               config=ProcessorConfig(max_batch_age_seconds=1), entities=False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    stats = log.read(spark, out, "batch_stats").where("not is_empty")
    assert stats.count() == 3  # one landed file per micro-batch
    assert log.read(spark, out, "events").count() == 6


def test_batches_follow_the_configured_bytes(spark):
    """ST2: four files of one size; a batch takes as many as the configured bytes allow."""
    from tidewater.operators.processor import ProcessorConfig
    base = tempfile.mkdtemp(prefix="tidewater-stream-")
    bronze = os.path.join(base, "bronze")
    for k in range(4):
        _land(spark, bronze, [_log("h", i) for i in range(2)], 10 * k)
    size = max(os.path.getsize(f) for f in glob.glob(os.path.join(bronze, "*.parquet")))
    for files_a_batch, want in ((1, [2, 2, 2, 2]), (2, [4, 4]), (9, [8])):
        cfg = ProcessorConfig(max_batch_bytes=files_a_batch * size + 1)
        out = os.path.join(base, f"out{files_a_batch}")
        st.start_normalisation(files.read_messages_stream(spark, bronze, options=st.admission(cfg, "files")), out,
                               out + "-ckpt", cfg, available_now=True, entities=False).awaitTermination()
        assert [r.events for r in log.read(spark, out, "batch_stats").orderBy("batch_id").collect()] == want
    topic = st.admission(ProcessorConfig(max_batch_size=500, max_batch_age_seconds=30), "kafka")
    assert topic == {"minOffsetsPerTrigger": "500", "maxTriggerDelay": "30s"}


def test_alerts_are_published_once_over_a_restart(spark):
    """ST8 / ST9: keyed host:database, own checkpoint, nothing twice."""
    base = tempfile.mkdtemp(prefix="tidewater-stream-")
    bronze, out, ckpt = (os.path.join(base, d) for d in ("bronze", "out", "ckpt"))
    slow = ("raw-queries", json.dumps({"host": "a", "database": "db9", "timestamp": "2025-01-01T00:00:00",
                                       "payload": {"query": "select 1", "mean_time_ms": 2000}}))
    for k, rows in enumerate(([_log("a", 0), slow], [_log("b", 1)], [])):
        if rows:
            _land(spark, bronze, rows, 10 * k)
        st.start_alerts(files.read_messages_stream(spark, bronze), out, ckpt, available_now=True).awaitTermination()
    got = sorted((r.key, json.loads(r.value)["rule"]) for r in log.read(spark, out, "alerts").collect())
    assert got == [("a:", "database_concurrency"), ("a:", "requires_alert"), ("a:db9", "slow_query"),
                   ("b:", "database_concurrency"), ("b:", "requires_alert")]
    assert [r.key for r in log.read(spark, out, "slow_queries").collect()] == ["a:db9"]
