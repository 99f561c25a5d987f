"""File sources, delimited tables and protobuf decoding."""

import gzip
import json
import os
import tempfile

from tidewater.plans.pipeline import process, route_events
from tidewater.sources import files, otlp_proto

LOG = {"timestamp": "2031-03-02T08:15:31", "data_type": "log", "host": "shop-db-7", "payload": {"event_type": "vacuum"}}
RM = {"resource": {"attributes": [{"key": "host.name", "value": {"stringValue": "shop-db-7"}}]},
      "scope_metrics": [{"metrics": [{"name": "pool.errors", "unit": "errors",
                                      "sum": {"data_points": [{"time_unix_nano": "1930000000500000000",
                                                               "as_int": "31"}]}}]}]}


def _tmp():
    return tempfile.mkdtemp(prefix="tidewater-test-")


def test_json_lines_routed_by_content(spark):
    d = _tmp()
    with open(os.path.join(d, "logs.jsonl"), "w") as f:
        f.write(json.dumps(LOG) + "\n" + json.dumps(LOG) + "\n" + "not json\n")
    msgs = files.read_json_lines(spark, d)
    out = process(msgs)
    assert out.events.count() == 2
    # equal lines are different events, and a second read gives them the same ids
    ids = sorted(r.id for r in out.events.collect())
    assert len(set(ids)) == 2 and ids == sorted(r.id for r in process(files.read_json_lines(spark, d)).events.collect())
    assert [r.reason for r in out.dead_letter.collect()] == ["not_json"]


def test_equal_lines_keep_their_number_whatever_the_splits(spark, monkeypatch):
    """Thousands of copies over many splits, spelt out in small runs: every line has an id of its own."""
    monkeypatch.setattr(files, "COPIES", 7)
    d = _tmp()
    with open(os.path.join(d, "a.jsonl"), "w") as f:
        f.write('{"x": 1}\n' * 1000 + '{"x": 2}\n' + '{"x": 1}\n' * 500)
    with open(os.path.join(d, "b.jsonl"), "w") as f:
        f.write('{"x": 1}\n' * 3)
    seen = []
    for size in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = files.read_json_lines(spark, d).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert len(rows) == 1504 and len({(r.partition, r.offset) for r in rows}) == 1504
        seen.append(sorted((r.partition, r.offset, r.value) for r in rows))
    assert seen[0] == seen[1]


def test_json_documents_array_of_resource_metrics(spark):
    d = _tmp()
    with open(os.path.join(d, "otel.json"), "w") as f:
        json.dump([RM, RM], f, indent=2)
    m = route_events(files.read_json_documents(spark, d, "otel-metrics"), "metrics")
    assert [r.metric_value for r in m.collect()] == [31.0, 31.0]


def test_delimited_table(spark):
    d = _tmp()
    with open(os.path.join(d, "t.txt"), "w") as f:
        f.write("2025-01-01|1|a\n2025-01-02|2|b\n")
    df = files.read_delimited(spark, d, "ts STRING, id BIGINT, text STRING", sep="|")
    assert [(r.id, r.text) for r in df.orderBy("id").collect()] == [(1, "a"), (2, "b")]


def test_protobuf_decode_plain_and_gzip():
    raw = otlp_proto.encode_export_request([json.dumps(RM)])
    for data in (raw, gzip.compress(raw)):
        out = [json.loads(t) for t in otlp_proto.decode_export_request(data)]
        assert len(out) == 1
        attrs = out[0]["resource"]["attributes"][0]
        # proto field spelling (snake_case), 64-bit integers as strings
        assert attrs == {"key": "host.name", "value": {"string_value": "shop-db-7"}}
        pt = out[0]["scope_metrics"][0]["metrics"][0]["sum"]["data_points"][0]
        assert pt["as_int"] == "31" and pt["time_unix_nano"] == "1930000000500000000"


def test_protobuf_messages_through_pipeline(spark, bronze):
    msgs = bronze([("otel-metrics", json.dumps(RM))])
    decoded = otlp_proto.decode_messages(otlp_proto.encode_messages(msgs, compress_every=1))
    r = route_events(decoded, "metrics").collect()[0]
    assert (r.entity_id, r.metric_name, r.metric_value, r.metric_type) == (
        "shop-db-7", "pool.errors", 31.0, "counter")


def test_otlp_log_documents(spark):
    """SR5: a file of OTLP JSON log requests; every record of every request becomes an event."""
    req = {"resourceLogs": [{"resource": {"attributes": [{"key": "host.name", "value": {"stringValue": "db1"}}]},
                             "scopeLogs": [{"logRecords": [
                                 {"timeUnixNano": "1697280000000000000", "body": {"stringValue": "a"}},
                                 {"timeUnixNano": "1697280001000000000", "body": {"stringValue": "b"}}]}]}]}
    d = _tmp()
    with open(os.path.join(d, "logs.json"), "w") as f:
        json.dump([req, req], f)
    ev = route_events(files.read_json_documents(spark, d, "raw-host-logs"), "host_logs")
    rows = ev.select("entity_id", "message", "event_type").collect()
    assert sorted(r.message for r in rows) == ["a", "a", "b", "b"]
    assert {(r.entity_id, r.event_type) for r in rows} == {("db1", "syslog")}
