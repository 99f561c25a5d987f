"""Paths that must not lose data: retention, syslog lines, damaged protobuf, shared folders."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewater.operators.analytics import retention
from tidewater.operators.processor import EVENT_FIELDS, Processor
from tidewater.plans.pipeline import process
from tidewater.session import shared_dir
from tidewater.sources.otlp_proto import decode_messages
from tidewater.sources.syslog import parse_syslog, syslog_events, unparsed_lines


def test_retention_keeps_topics_without_an_age(spark):
    old = dt.datetime(2020, 1, 1)
    df = spark.createDataFrame([("raw-logs", old), ("", old), ("mine", old), (None, old)],
                               "topic string, ingest_ts timestamp")
    assert {r.topic for r in retention(df, "2024-01-30").collect()} == {"", "mine", None}


def test_syslog_year_ids_and_unparsed_lines(spark):
    at = dt.datetime(2025, 1, 1, 0, 0, 5)
    line = "<13>Dec 31 23:59:59 edge7 cron[9]: tick"
    df = spark.createDataFrame([("syslog", 0, 1, line, at), ("syslog", 1, 1, line, at), ("syslog", 1, 2, "??", at)],
                               "topic string, `partition` int, `offset` long, value string, ingest_ts timestamp")
    assert [r.ts.year for r in parse_syslog(df).where("parsed").collect()] == [2024, 2024]
    assert syslog_events(df).select("id").distinct().count() == 2
    assert [(r.offset, r.reason) for r in unparsed_lines(df).collect()] == [(2, "not_syslog")]


def test_damaged_protobuf_stays_a_message(spark):
    df = spark.createDataFrame([(0, 9 * 10**17, None, bytearray(b"\x1f\x8b broken"), dt.datetime(2025, 1, 1))],
                               "`partition` int, `offset` long, key string, value binary, ingest_ts timestamp")
    [row] = decode_messages(df).collect()
    assert row.value.startswith("undecodable protobuf") and row.offset == 9 * 10**17
    assert decode_messages(df).select(F.try_parse_json("value").alias("v")).where("v is null").count() == 1


def test_shared_dir_needs_a_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_dir(Session())


BAD = [("raw-logs", '{"host"', "not_json"), ("raw-logs", "[1]", "not_object"), ("raw-logs", "", "not_json"),
       ("other", json.dumps({"data_type": "x"}), "unrouted"), ("", json.dumps({}), "unrouted"),
       ("raw-queries", json.dumps({"payload": None}), "null_field:payload"),
       ("otel-metrics", "{", "not_json"), ("otel-metrics", "3", "not_object"),
       ("otel-metrics", "{}", "missing:scope_metrics"),
       ("otel-metrics", json.dumps({"scope_metrics": "oops"}), "bad_type:scope_metrics"),
       ("otel-metrics", json.dumps({"scopeMetrics": []}), "empty:scope_metrics"),
       ("", json.dumps({"scope_metrics": [{"metrics": []}]}), "no_points"),
       ("otel-metrics", json.dumps({"scope_metrics": [{"metrics": [{"gauge": {"data_points": [{}]}}]}]}), "no_points"),
       ("raw-host-logs", "[]", "not_object"), ("raw-host-logs", "{}", "missing:resourceLogs"),
       ("raw-host-logs", json.dumps({"resourceLogs": {"a": 1}}), "bad_type:resourceLogs"),
       ("raw-host-logs", json.dumps({"resourceLogs": []}), "empty:resourceLogs"),
       ("raw-host-logs", json.dumps({"resourceLogs": [{"scopeLogs": []}]}), "empty:logRecords"),
       ("syslog", "no such line", "not_syslog")]
GOOD = [("raw-logs", json.dumps({"payload": {}})), ("", json.dumps({"data_type": "query", "payload": {}})),
        ("otel-metrics", json.dumps({"scopeMetrics": [{"metrics": [{"sum": {"dataPoints": [{"asInt": "4"}]}}]}]})),
        ("raw-host-logs", json.dumps({"resourceLogs": [{}, {"scopeLogs": [{"logRecords": [{}]}]}]})),
        ("syslog", "<13>Dec 31 23:59:59 edge7 cron[9]: tick")]


def test_every_message_is_stored_or_has_a_reason(bronze):
    out = process(bronze([*GOOD, *((t, v) for t, v, _ in BAD)]))
    assert [r.reason for r in out.dead_letter.orderBy("offset").collect()] == [r for _, _, r in BAD]
    assert out.events.count() == 4 and out.metrics.count() == 1


def test_a_route_of_ones_own_and_a_registry_without_metrics(bronze):
    """UD1: a processor brings its topic, its reasons and its rows; nothing else is registered."""
    class Heartbeats(Processor):
        route, topics = "beats", ("beats",)

        def reason(self):
            return F.when(~F.col("value").like("beat %"), F.lit("no_beat"))

        def normalize(self, df):
            empty = F.create_map().cast("map<string,string>")
            made = {"timestamp": F.col("ingest_ts"), "entity_id": F.substring("value", 6, 99), "tags": empty,
                    "event_type": F.lit("beat"), "source": F.lit("beats"), "environment": F.lit("test"),
                    "message": F.col("value"), "attributes": F.create_map().cast("map<string,variant>"),
                    "id": F.col("offset").cast("string"), "created_at": F.col("ingest_ts")}
            return df.select(*[made.get(c, F.lit(None).cast("string")).alias(c) if c != "topic" else F.col(c)
                               for c in EVENT_FIELDS])

    out = process(bronze([("beats", "beat a"), ("beats", "??"), ("raw-logs", "{}")]), processors={"beats": Heartbeats()})
    assert [(r.entity_id, r.event_type) for r in out.events.collect()] == [("a", "beat")]
    assert [r.reason for r in out.dead_letter.collect()] == ["no_beat"]
    assert out.metrics.count() == 0
