"""SK6 layout: date partitions, rows sorted on the sort key inside each file."""

import glob
import os
import tempfile
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidewater.plans.pipeline import route_events
from tidewater.sinks import lifecycle as life
from tidewater.sinks import tables as sk
from tidewater.sources import testdata as td

SF = "/root/testdata/sf0.001"


def test_events_table_layout(spark):
    ev = route_events(td.query_messages(td.load(spark, SF, "events")), "queries")
    path = os.path.join(tempfile.mkdtemp(prefix="tidewater-sink-"), "events")
    sk.write_events(ev, path, partitions=4, mode="overwrite")
    parts = sorted(os.path.basename(p) for p in glob.glob(os.path.join(path, "event_date=*")))
    assert parts and all(p.startswith("event_date=2024-01-") for p in parts)
    for f in glob.glob(os.path.join(path, "event_date=*", "*.parquet")):
        t = pq.read_table(f, columns=["entity_id", "timestamp"]).to_pandas()
        keys = list(zip(t["entity_id"], t["timestamp"]))
        assert keys == sorted(keys)
    back = spark.read.parquet(path)
    assert back.count() == ev.count()
    assert set(back.columns) >= {"timestamp", "entity_id", "event_type", "tags", "attributes", "id"}


def test_time_range_reader_prunes_partitions(spark):
    ev = route_events(td.query_messages(td.load(spark, SF, "events")), "queries")
    path = os.path.join(tempfile.mkdtemp(prefix="tidewater-sink-"), "events")
    sk.write_events(ev, path, mode="overwrite")
    df = sk.read_table(spark, path, "2024-01-05 00:00:00", "2024-01-06 23:59:59")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert df.count() == ev.where("timestamp between '2024-01-05 00:00:00' and '2024-01-06 23:59:59'").count()


def test_keyed_publish_to_topic_files(spark):
    """SK5/SK9: key = host:database, JSON value, one folder per topic (Kafka stand-in)."""
    import json as _json

    from pyspark.sql import functions as F
    env = spark.createDataFrame([("h1", "db1", 3), ("h2", "db2", 0)], "host STRING, database STRING, n INT")
    frame = sk.keyed_frame(env, F.when(F.col("n") > 0, "alerts").otherwise("processed-logs"))
    out = os.path.join(tempfile.mkdtemp(prefix="tidewater-sink-"), "topics")
    sk.publish(frame, out)
    topics = sorted(os.path.basename(p) for p in glob.glob(os.path.join(out, "topic=*")))
    assert topics == ["topic=alerts", "topic=processed-logs"]
    rows = spark.read.json(out).orderBy("key").collect()
    assert [r.key for r in rows] == ["h1:db1", "h2:db2"]
    assert _json.loads(rows[0].value) == {"host": "h1", "database": "db1", "n": 3}


def _day_rows(spark, n, days):
    at = F.timestamp_seconds(F.col("id") % days * 86400 + F.col("id") % 1000 + 1704067200)
    return spark.range(n).select(
        at.alias("timestamp"), F.concat(F.lit("e"), F.col("id") % 9).alias("entity_id"), F.when(F.col("id") % 50 > 0, F.to_date(at)).alias("event_date"),
        F.col("id").cast("string").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("message"))


def test_a_large_table_is_written_in_slices_of_days_and_leaves_no_landed_rows(spark, tmp_path, monkeypatch):
    rows, path = _day_rows(spark, 4000, 13), str(tmp_path / "t")
    monkeypatch.setattr(sk, "SLICE_ROWS", 700)
    landed, fresh = [], sk.shared_dir
    monkeypatch.setattr(sk, "shared_dir", lambda s, name: landed.append(fresh(s, name)) or landed[-1])
    for mode, times in (("append", 1), ("append", 2), ("overwrite", 1)):
        sk._write_sorted(rows, path, ["entity_id", "timestamp"], None, mode, ["event_date"], ("id",))
        back = spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
        assert back.count() == times * 4000 and back.exceptAll(rows).count() == (times - 1) * 4000
        assert rows.exceptAll(back).count() == 0
    for f in glob.glob(os.path.join(path, "event_date=*", "*.parquet")):
        t = pq.ParquetFile(f).read(columns=["entity_id", "timestamp"]).to_pylist()
        assert t == sorted(t, key=lambda r: (r["entity_id"], r["timestamp"]))
    assert len(landed) == 3 and all(spark.read.parquet(p).count() == 0 for p in landed)
    slices = sk.day_slices(rows, "event_date")
    assert 5 <= len(slices) <= sk.SLICES + 1 and sum(rows.where(s).count() for s in slices) == 4000
    sk._write_sorted(rows.limit(0), str(tmp_path / "none"), ["entity_id"], None, "append", ["event_date"])
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "none")).count() == 0


def test_the_shuffle_files_of_a_written_table_are_gone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sk, "SLICE_ROWS", 700)
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: sum("shuffle_" in f.getName() for f in iter(
        [local.getAllFiles().apply(i) for i in range(local.getAllFiles().size())]))
    before = shuffled()
    sk._write_sorted(_day_rows(spark, 4000, 13), str(tmp_path / "t"), ["entity_id"], None, "append", ["event_date"])
    deadline = time.time() + 20
    while shuffled() > before and time.time() < deadline:
        time.sleep(0.5)
    assert shuffled() <= before


def test_tables_are_filled_in_slices_of_days_with_a_file_a_bucket_and_day(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sk, "SLICE_ROWS", 700)
    schema = f"filled_{os.urandom(4).hex()}"
    life.create_tables(spark, schema, str(tmp_path / "db"))
    columns = spark.table(f"{schema}.events").schema
    rows = _day_rows(spark, 4000, 13)
    rows = rows.select(*[c.name if c.name in rows.columns else F.lit(None).cast(c.dataType).alias(c.name) for c in columns])
    life.insert(rows, schema, "events")
    back = spark.table(f"{schema}.events")
    assert back.count() == 4000 and back.exceptAll(rows).count() == 0 == rows.exceptAll(back).count()
    files = glob.glob(str(tmp_path / "db" / "events" / "event_date=*" / "*.parquet"))
    buckets = rows.select("event_date", F.pmod(F.hash("entity_id"), F.lit(life.BUCKETS))).distinct().count()
    assert len(files) == buckets
    spark.sql(f"DROP DATABASE {schema} CASCADE")
