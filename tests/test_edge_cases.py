"""One test per documented quirk and the routing rules."""

import json

from pyspark.sql import functions as F

from tidewater.functions.expr import vget
from tidewater.operators.logs import normalize_otlp_logs
from tidewater.operators.processor import ProcessorConfig
from tidewater.operators.route import dead_letter, prepare, routed
from tidewater.plans.pipeline import process, route_events
from tidewater.sources.syslog import parse_syslog

TS_NS = "1697280000000000000"


def _metric(points, kind="gauge", name="m"):
    return json.dumps({"resource": {"attributes": [{"key": "host.name", "value": {"stringValue": "h"}}]},
                       "scope_metrics": [{"metrics": [{"name": name, kind: {"data_points": points}}]}]})


def _values(bronze, value):
    m = route_events(bronze([("otel-metrics", value)]), "metrics")
    return sorted(r.metric_value for r in m.collect())


def test_k1_snake_and_camel_attribute_values(bronze):
    doc = {"resource": {"attributes": [{"key": "host.name", "value": {"string_value": "snake"}},
                                       {"key": "db.system", "value": {"stringValue": "camel"}},
                                       {"key": "port", "value": {"int_value": "5432"}}]},
           "scopeMetrics": [{"metrics": [{"name": "x", "gauge": {"dataPoints": [
               {"timeUnixNano": TS_NS, "asInt": "3"}]}}]}]}
    r = route_events(bronze([("otel-metrics", json.dumps(doc))]), "metrics").collect()[0]
    assert (r.entity_id, r.source, r.metric_value) == ("snake", "camel", 3.0)


def test_k2_all_log_records_and_first_only(bronze):
    doc = {"resourceLogs": [{"resource": {"attributes": [{"key": "host.name", "value": {"stringValue": "h1"}}]},
                             "scopeLogs": [{"logRecords": [
                                 {"timeUnixNano": TS_NS, "body": {"stringValue": "a"}},
                                 {"timeUnixNano": TS_NS, "body": {"stringValue": "b"},
                                  "attributes": [{"key": "k", "value": {}}]}]}]}]}
    p = routed(prepare(bronze([("raw-host-logs", json.dumps(doc))])), "host_logs")
    all_rows = normalize_otlp_logs(p).collect()
    assert sorted(r.message for r in all_rows) == ["a", "b"]
    assert {r.entity_id for r in all_rows} == {"h1"}
    assert [dict(r.tags) for r in all_rows if r.message == "b"] == [{"k": ""}]
    assert [r.message for r in normalize_otlp_logs(p, first_only=True).collect()] == ["a"]


def test_k3_zero_values_kept(bronze):
    v = _values(bronze, _metric([{"time_unix_nano": TS_NS, "as_int": "0"},
                                 {"time_unix_nano": TS_NS, "as_double": 0},
                                 {"time_unix_nano": TS_NS}]))
    assert v == [0.0, 0.0]


def test_k4_histogram_without_values(bronze):
    assert _values(bronze, _metric([{"time_unix_nano": TS_NS, "count": "3"}], kind="histogram")) == []


def test_k5_sum_is_counter_and_timestamp_default(bronze):
    m = route_events(bronze([("otel-metrics", _metric([{"as_double": 1.5}], kind="sum"))]), "metrics")
    r = m.collect()[0]
    assert r.metric_type == "counter" and str(r.timestamp) == "1970-01-01 00:00:00"


def test_k6_query_type_substring_rules(bronze):
    rows = [("raw-queries", json.dumps({"payload": {"query": q, "mean_time_ms": 1}}))
            for q in ["INSERT INTO a SELECT * FROM b",
                      "CREATE TABLE t (updated_at timestamp)", "VACUUM"]]
    ev = route_events(bronze(rows), "queries")
    got = {r.q: r.t for r in ev.select(vget(F.col("attributes")["query"]).alias("q"),
                                       F.col("tags")["query_type"].alias("t")).collect()}
    assert got == {"INSERT INTO a SELECT * FROM b": "read",
                   "CREATE TABLE t (updated_at timestamp)": "write", "VACUUM": None}


def test_k7_k23_dead_letters(bronze):
    rows = [("raw-logs", '{"host": "h"'),
            ("raw-logs", "[1, 2]"),
            ("raw-logs", json.dumps({"host": None, "payload": {}})),
            ("raw-queries", json.dumps({"payload": None})),
            ("raw-queries", json.dumps({"payload": {"mean_time_ms": "slow"}})),
            ("raw-queries", json.dumps({"payload": {"query": 5}})),
            ("raw-logs", json.dumps({"payload": {"event_type": 7}})),
            ("raw-logs", json.dumps({"tags": {"a": {"b": 1}}, "payload": {}})),
            ("raw-host-logs", json.dumps({"resourceLogs": []})),
            ("raw-logs", json.dumps({"payload": {}}))]
    dl = {r.offset: r.reason for r in dead_letter(prepare(bronze(rows))).collect()}
    assert dl == {0: "not_json", 1: "not_object", 2: "null_field:host", 3: "null_field:payload",
                  4: "bad_type:mean_time_ms", 5: "bad_type:query", 6: "bad_type:event_type",
                  7: "bad_type:tags", 8: "empty:resourceLogs"}
    assert dead_letter(prepare(bronze(rows))).where("length(sample) > 200").count() == 0


def test_k9_replay_gives_same_id(bronze):
    msg = ("raw-logs", json.dumps({"host": "h", "payload": {}}))
    a = route_events(bronze([msg]), "logs").collect()[0].id
    b = route_events(bronze([msg]), "logs").collect()[0].id
    assert a == b and len(a) == 64


def test_k14_k15_defaults(bronze):
    rows = [("raw-logs", json.dumps({"payload": {}})),
            ("raw-host-logs", json.dumps({"resourceLogs": [{"scopeLogs": [{"logRecords": [{}]}]}]})),
            ("otel-metrics", _metric([{"as_int": "1"}]).replace('"host.name"', '"other"'))]
    out = process(bronze(rows))
    ev = {r.event_type: r for r in out.events.collect()}
    assert (ev["log"].entity_id, ev["log"].source, ev["log"].environment) == ("unknown", "unknown", "production")
    assert (ev["syslog"].entity_id, ev["syslog"].message) == ("unknown_syslog_host", "No message body")
    assert str(ev["syslog"].timestamp) == "2025-01-01 00:00:00"  # no time → ingest time
    assert out.metrics.collect()[0].entity_id == "unknown_host"


def test_k19_unicode_whitespace_fingerprint(bronze):
    rows = [("raw-queries", json.dumps({"payload": {"query": q, "mean_time_ms": 1}}))
            for q in ["SELECT 1", "  select 1\n", "SELECT 1"]]
    ev = route_events(bronze(rows), "queries")
    assert ev.select(vget(F.col("attributes")["query_hash"]).alias("h")).distinct().count() == 1


def test_k21_duplicate_keys_last_wins(bronze):
    doc = {"resource": {"attributes": [{"key": "host.name", "value": {"stringValue": "first"}},
                                       {"key": "host.name", "value": {"stringValue": "last"}}]},
           "scope_metrics": [{"metrics": [{"name": "x", "gauge": {"data_points": [{"as_int": "1"}]}}]}]}
    assert route_events(bronze([("otel-metrics", json.dumps(doc))]), "metrics").collect()[0].entity_id == "last"


def test_k22_numeric_strings(bronze):
    v = _values(bronze, _metric([{"as_int": "12d"}, {"as_int": "1_000"}, {"as_double": "2.5"},
                                 {"as_int": "abc"}]))
    assert v == [2.5, 1000.0]


def test_timestamps(bronze):
    rows = [("raw-logs", json.dumps({"timestamp": t, "payload": {}}))
            for t in ["2025-10-14T16:01:47.596379", "2025-10-14T16:01:47Z",
                      "2025-10-14T18:01:47+02:00", "10:30:00", "2025", 12345]]
    ev = route_events(bronze(rows), "logs").orderBy("id")
    got = sorted(str(r.timestamp) for r in ev.collect())
    assert got == ["2025-01-01 00:00:00"] * 3 + ["2025-10-14 16:01:47", "2025-10-14 16:01:47",
                                                   "2025-10-14 16:01:47.596379"]


def test_content_routing(bronze):
    rows = [("", json.dumps({"data_type": "log", "payload": {}})),
            ("", json.dumps({"data_type": "query", "payload": {}})),
            ("", json.dumps({"scope_metrics": []})),
            ("other", json.dumps({"data_type": "x"}))]
    r = {x.offset: x.route for x in prepare(bronze(rows)).collect()}
    assert r == {0: "logs", 1: "queries", 2: "metrics", 3: "ignored"}


def test_syslog_rfc3164(spark):
    df = spark.createDataFrame([("<34>Oct 11 22:14:15 myhost su[12]: failed login",
                                 "2025-10-12 00:00:00")], "value STRING, ingest_ts STRING")
    df = df.withColumn("ingest_ts", F.col("ingest_ts").cast("timestamp"))
    r = parse_syslog(df).collect()[0]
    assert (r.facility, r.severity, r.host, r.app, r.pid, r.msg) == (4, 2, "myhost", "su", "12", "failed login")
    assert str(r.ts) == "2025-10-11 22:14:15"


def test_fp11_validation_drop(bronze):
    rows = [("otel-metrics", _metric([{"as_double": "NaN"}, {"as_double": "1"}]))]
    keep = process(bronze(rows))
    assert keep.metrics.where(F.size("violations") > 0).count() == 1
    drop = process(bronze(rows), ProcessorConfig(drop_invalid=True))
    assert drop.metrics.count() == 1


def test_fp8_fp10_enrichment(bronze):
    rows = [("raw-logs", json.dumps({"tags": {"log_level": "emergency"}, "payload": {"event_type": "deadlocks"}})),
            ("otel-metrics", _metric([{"as_double": 2}], name="app.error.count")),
            ("otel-metrics", _metric([{"as_double": 0}], name="app.error.count"))]
    out = process(bronze(rows))
    t = out.events.collect()[0].tags
    assert t["requires_alert"] == "true" and t["category"] == "database_concurrency"
    sev = sorted((r.metric_value, r.tags.get("severity")) for r in out.metrics.collect())
    assert sev == [(0.0, None), (2.0, "warning")]


def test_enrichment_off(bronze):
    rows = [("raw-logs", json.dumps({"tags": {"log_level": "error"}, "payload": {}}))]
    out = process(bronze(rows), ProcessorConfig(enable_enrichment=False))
    assert "requires_alert" not in out.events.collect()[0].tags


def test_fp12_resource_upsert_on_host_logs(bronze):
    from tidewater.operators.logs import HostLogsProcessor
    doc = {"resourceLogs": [{"resource": {"attributes": [
        {"key": "host.name", "value": {"stringValue": "h1"}},
        {"key": "deployment.environment", "value": {"stringValue": "staging"}}]},
        "scopeLogs": [{"logRecords": [{"timeUnixNano": TS_NS, "body": {"stringValue": "x"}}]}]}]}
    p = routed(prepare(bronze([("raw-host-logs", json.dumps(doc))])), "host_logs")
    plain = HostLogsProcessor().process(p).collect()[0]
    upsert = HostLogsProcessor(resource_upserts={"deployment.environment": "development"}).process(p).collect()[0]
    assert (plain.environment, upsert.environment) == ("staging", "development")
    assert upsert.entity_id == "h1"


def test_sc3_fingerprint_matches_python_split(spark):
    """Whitespace handling of the fingerprint equals ``' '.join(s.lower().split())`` + SHA-256."""
    import hashlib
    import random

    from tidewater.functions.expr import normalise_sql, query_fingerprint
    rnd = random.Random(7)
    spaces = [" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", " ",
              " ", "　", " "]
    words = ["SELECT", "from", "Users", "WHERE", "id", "=", "$1", "Ünïcode", "(x)"]
    texts = ["".join(rnd.choice(spaces + words) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "q STRING")
    got = df.select("q", normalise_sql(F.col("q")).alias("n"), query_fingerprint(F.col("q")).alias("h")).collect()
    for r in got:
        want = " ".join(r.q.lower().split())
        assert r.n == want, (r.q, r.n, want)
        assert r.h == hashlib.sha256(want.encode()).hexdigest()[:16]
