"""Queries give every row and value their SQL names; rows are built here."""

from pyspark.sql import functions as F

from tidewater.functions.expr import py_str, vget, vnumber
from tidewater.operators import analytics as an
from tidewater.plans import catalog
from tidewater.session import settings
from tidewater.sources import testdata as td

AT = "2024-01-01 00:00:00"


def _rows(spark, rows, columns):
    return spark.createDataFrame(rows, columns).withColumn("timestamp", F.lit(AT).cast("timestamp"))


def test_entity_lookup_derives_entities_from_events_too(spark, monkeypatch):
    events = _rows(spark, [("a", "log", "app", "dev"), ("a", "log", "app", "dev"), ("b", "log", "postgresql", "dev"),
                           ("c", "syslog", "syslog", "dev")],
                   "entity_id string, event_type string, source string, environment string")
    metrics = _rows(spark, [("c", "postgresql", "dev")], "entity_id string, source string, environment string")
    monkeypatch.setattr(catalog, "stored", lambda *_: (events, metrics))
    got = {tuple(r) for r in catalog.q_entity_lookup(spark, "").select("event_type", "entity_type", "events").collect()}
    assert got == {("log", "host", 2), ("log", "database_host", 1), ("syslog", "database_host", 1)}


def test_trace_correlation_names_the_entities(spark):
    events = _rows(spark, [("t", "b", "log"), ("t", "a", "log"), ("t", "b", "syslog"), ("u", "a", "log"), (None, "a", "log")],
                   "trace_id string, entity_id string, event_type string")
    got = {r.trace_id: (r.events, r.entities, r.event_types) for r in an.trace_correlation(events).collect()}
    assert got == {"t": (3, "a,b", "log,syslog"), "u": (1, "a", "log")}


def test_landed_messages_of_a_topic_lie_in_every_file(spark, tmp_path):
    events = spark.range(20000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + 1704067200).alias("ts"),
        (F.col("id") % 50).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"),
        F.sha2(F.col("id").cast("string"), 256).alias("props"))
    landed = catalog.land_bronze(spark, td.raw_messages(events), str(tmp_path / "bronze"))
    files = landed.groupBy("topic", F.input_file_name().alias("f")).count().collect()
    assert sum(r["count"] for r in files if r.topic in ("raw-queries", "raw-logs", "")) == 40000
    per_file = [r["count"] for r in files if r.topic == "raw-queries"]
    assert len(per_file) == len({r.f for r in files}) > 1
    assert max(per_file) < 2 * sum(per_file) / len(per_file)


def _events(spark, n):
    return spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + 1704067200).alias("ts"),
        (F.col("id") % 50).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.5).alias("value"),
        F.lit("{}").alias("props"))


def test_a_query_of_one_kind_writes_that_kind_and_the_table_is_whole_in_the_end(spark, tmp_path):
    sf = str(tmp_path / "sf")
    _events(spark, 3000).write.parquet(f"{sf}/events.parquet")
    logs = catalog.stored_events(spark, sf, "log")
    base = catalog._stored[spark.sparkContext.applicationId, sf]
    count = lambda: {r.event_type: r["count"] for r in spark.read.parquet(
        f"{base}/events").groupBy("event_type").count().collect()}
    first = count()
    assert set(first) == {"log"} and logs.count() == first["log"]
    whole = catalog.stored_events(spark, sf)
    straight = {r.event_type: r["count"] for r in catalog.pipeline(spark, sf).events.groupBy("event_type").count().collect()}
    assert count() == straight and set(straight) == {"log", "database_query", "syslog"}
    assert whole.count() == sum(straight.values()) == catalog.stored_events(spark, sf).count()
    assert catalog.stored_metrics(spark, sf).count() == catalog.pipeline(spark, sf).metrics.count() == 3000


def test_otlp_rows_are_dealt_once_to_all_tasks(spark):
    for messages in (td.otlp_metric_messages, td.otlp_log_messages):
        plan = messages(_events(spark, 3000))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 == plan.count("REPARTITION_BY_NUM")


def test_numbers_read_from_their_text_are_those_of_the_variant_cast(spark):
    texts = ["1", "-0", "12.5", "1e3", "1.0", "123456789012345678901", "0.1", "1e400", '"7"', '"x"', '"NaN"', "true",
             "null", "{}", "[1]", "9223372036854775807", "1e-7", "123456789.123456789"]
    v = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.try_parse_json("t").alias("v"))
    for kind in ("double", "bigint"):
        for r in v.select("t", vnumber(F.col("v"), kind).alias("a"), vget(F.col("v"), kind).alias("b")).collect():
            assert str(r.a) == str(r.b), (kind, r)
    m = F.create_map(F.lit("k"), F.col("v"))
    for r in v.where("v is not null").select("t", py_str(m, "k", "-").alias("a"), F.when(
            F.is_variant_null("v"), "None").otherwise(vget(F.col("v"))).alias("b")).collect():
        assert r.a == r.b, r


def test_one_route_alone_parses_its_own_messages_and_gives_the_rows_of_the_whole_job(spark, bronze):
    from tidewater.plans.pipeline import process, route_events
    events = _events(spark, 300)
    odd = bronze([("", '{"data_type":"query","host":"h","payload":{"mean_time_ms":"x"}}'), ("", "[1]"), ("x", "{"),
                  ("", '{"data_type":"query","host":null,"payload":{}}'), ("raw-logs", '{"payload":{"event_type":7}}'),
                  ("raw-host-logs", '{"data_type":"log","payload":{}}'), ("raw-host-logs", "no"),
                  ("", '{"scope_metrics":[{"metrics":[{"name":"m","gauge":{"dataPoints":[{"asInt":"1_0"}]}}]}]}'),
                  ("otel-metrics", '{"scopeMetrics":[]}'), ("raw-queries", '{"tags":{"a":{}},"payload":{}}'),
                  ("", '{"data_type":"log","tags":{"a":1}}'), ("raw-queries", '{"data_type":"log"}')])
    messages = td.raw_messages(events).unionByName(odd)
    whole = process(messages)
    shown = lambda df: sorted(r.id + str(r.entity_id) for r in df.collect())
    for route, kind in (("queries", "database_query"), ("logs", "log"), ("host_logs", "syslog"), ("metrics", None)):
        alone = route_events(messages, route)
        assert shown(alone) == shown(whole.events.where(F.col("event_type") == kind) if kind else whole.metrics) != []
        plan = alone._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(StructField") == (route in ("host_logs", "metrics")), route


def test_host_logs_land_no_messages_that_content_cannot_route_to_them(spark, tmp_path):
    sf = str(tmp_path / "sf")
    _events(spark, 500).write.parquet(f"{sf}/events.parquet")
    catalog.stored_events(spark, sf, "syslog")
    base = catalog._stored[spark.sparkContext.applicationId, sf]
    assert {r.topic for r in spark.read.parquet(f"{base}/bronze/syslog").select("topic").distinct().collect()} == {"raw-host-logs"}


def test_the_batches_of_a_stream_follow_its_bytes_not_the_tasks_that_landed_them(spark, tmp_path, monkeypatch):
    sf = str(tmp_path / "sf")
    _events(spark, 2000).write.parquet(f"{sf}/events.parquet")
    start, landed, ended = catalog.st.start_normalisation, [], []
    read = catalog.src.read_messages_stream
    monkeypatch.setattr(catalog.src, "read_messages_stream", lambda s, path, **k: landed.append(path) or read(s, path, **k))
    monkeypatch.setattr(catalog.st, "start_normalisation", lambda *a, **k: ended.append(start(*a, **k)) or ended[-1])
    with settings(spark, {"spark.sql.shuffle.partitions": "30"}):
        got = {r.event_type: r["sum(events)"] for r in catalog.q_stream_normalize(spark, sf).groupBy(
            "event_type").sum("events").collect()}
        straight = catalog.pipeline(spark, sf).events.groupBy("event_type").count().collect()
        messages = td.raw_messages(td.load(spark, sf, "events"))
        assert spark.read.parquet(landed[0]).exceptAll(messages).count() == 0 == messages.exceptAll(
            spark.read.parquet(landed[0])).count()
    assert got == {r.event_type: r["count"] for r in straight} and set(got) == {"log", "database_query", "syslog"}
    assert len([p for p in ended[0].recentProgress if p.numInputRows]) == 1
