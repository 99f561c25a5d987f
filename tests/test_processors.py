"""What each processor makes of one message of its route."""

import hashlib
import json

from pyspark.sql import functions as F

from tidewater.functions.expr import vget
from tidewater.plans.pipeline import process, route_events

SLOW_READ = {
    "timestamp": "2031-03-02T08:15:30.250001", "source": "mysql", "data_type": "query",
    "host": "shop-db-7", "database": "shop", "environment": "staging", "tags": {},
    "payload": {"queryid": "ab12", "query": "Select  sku,\tprice FROM catalogue", "calls": 3,
                "total_time_ms": 4501.5, "mean_time_ms": 1500.5}}
SESSIONS = {
    "timestamp": "2031-03-02T08:15:31", "source": "mysql", "data_type": "log", "host": "shop-db-7",
    "database": "shop", "environment": "staging", "tags": {"log_level": "notice"},
    "payload": {"event_type": "connection_stats", "total": 40, "active": 13, "idle": 27}}


def _attr(k, v, kind="stringValue"):
    return {"key": k, "value": {kind: v}}


def _gauge(name, unit, **value):
    return {"name": name, "description": f"about {name}", "unit": unit, "gauge": {"data_points": [
        {"time_unix_nano": "1930000000500000000", "attributes": [_attr("database", "shop")], **value}]}}


POOL_METRICS = {
    "resource": {"attributes": [_attr("host.name", "shop-db-7"), _attr("db.system", "mysql"),
                                _attr("deployment.environment", "staging")]},
    "scope_metrics": [
        {"metrics": [_gauge("pool.waiting", "threads", as_int="19"), _gauge("pool.load", "1", as_double=0.75)]},
        {"metrics": [{"name": "pool.errors", "unit": "errors",
                      "sum": {"data_points": [{"as_int": "2"}, {"as_int": "5"}]}}]}]}


def test_query_event(bronze):
    ev = route_events(bronze([("raw-queries", json.dumps(SLOW_READ))]), "queries")
    r = ev.select("timestamp", "event_type", "entity_id", "message", F.col("tags")["performance"].alias("perf"),
                  F.col("tags")["query_type"].alias("qt"), "source", "database",
                  vget(F.col("attributes")["mean_time_ms"], "double").alias("mean"),
                  vget(F.col("attributes")["query_hash"]).alias("h")).collect()[0]
    assert str(r.timestamp) == "2031-03-02 08:15:30.250001"
    assert (r.event_type, r.entity_id, r.source, r.database) == ("database_query", "shop-db-7", "mysql", "shop")
    assert r.message == "Query executed 3 times with avg latency 1500.50ms."
    assert r.h == hashlib.sha256(b"select sku, price from catalogue").hexdigest()[:16]
    assert (r.mean, r.perf, r.qt) == (1500.5, "slow", "read")


def test_log_event(bronze):
    ev = route_events(bronze([("raw-logs", json.dumps(SESSIONS))]), "logs")
    r = ev.select("event_type", "entity_id", "message", "tags").collect()[0]
    assert (r.event_type, r.entity_id, r.message) == ("log", "shop-db-7", "13/40 active connections.")
    assert r.tags == {"log_level": "notice"}


def test_metric_points(bronze):
    rows = route_events(bronze([("otel-metrics", json.dumps(POOL_METRICS))]), "metrics").collect()
    assert sorted((r.metric_name, r.metric_type, r.metric_value, r.unit) for r in rows) == [
        ("pool.errors", "counter", 2.0, "errors"), ("pool.errors", "counter", 5.0, "errors"),
        ("pool.load", "gauge", 0.75, "1"), ("pool.waiting", "gauge", 19.0, "threads")]
    assert {(r.entity_id, r.source, r.environment) for r in rows} == {("shop-db-7", "mysql", "staging")}
    r = next(r for r in rows if r.metric_name == "pool.load")
    assert (str(r.timestamp), dict(r.tags)) == ("2031-02-27 23:06:40.500000", {"database": "shop"})
    assert len({r.id for r in rows}) == 4


def test_log_message_templates(bronze):
    payloads = [({"event_type": "deadlocks", "count": 3}, "Detected 3 deadlock(s).", "database_concurrency"),
                ({"event_type": "query_error", "error_code": "42P01"}, "Query error 42P01: Unknown", None),
                ({"event_type": "vacuum"}, "Log event of type 'vacuum' received.", None),
                ({}, "Log event of type 'unknown event' received.", None)]
    rows = [("raw-logs", json.dumps({"host": "h", "payload": p})) for p, _, _ in payloads]
    got = route_events(bronze(rows), "logs").collect()
    by_msg = {r.message: r for r in got}
    for _, msg, cat in payloads:
        assert msg in by_msg
        assert by_msg[msg].tags.get("category") == cat
        assert by_msg[msg].tags["log_level"] == "info"
        assert by_msg[msg].environment == "production"


def test_query_classes(bronze):
    """Latency class and read / write of own statements, bounds included."""
    cases = [("ALTER TABLE stock ADD COLUMN place int", 100.0, "good", None),
             ("Insert into stock values ($1)", 100.5, "acceptable", "write"),
             ("update stock set n = n - 1", 1000.0, "acceptable", "write"),
             ("DELETE FROM stock WHERE id IN (SELECT id FROM gone)", 1000.1, "slow", "read")]
    rows = [("raw-queries", json.dumps({"host": "h", "payload": {"query": q, "calls": 1, "mean_time_ms": m}}))
            for q, m, _, _ in cases]
    ev = route_events(bronze(rows), "queries")
    res = {r.q: (r.p, r.t) for r in ev.select(vget(F.col("attributes")["query"]).alias("q"),
                                              F.col("tags")["performance"].alias("p"),
                                              F.col("tags")["query_type"].alias("t")).collect()}
    assert res == {q: (perf, qt) for q, _, perf, qt in cases}


def test_mixed_topics_give_each_kind_its_rows(bronze):
    """Latencies 0.5 ms times powers of three around both class bounds, each with its log and metric."""
    rows = []
    for k in range(9):
        query = {**SLOW_READ, "payload": {**SLOW_READ["payload"], "mean_time_ms": 0.5 * 3 ** k}}
        rows += [("raw-queries", json.dumps(query)), ("", json.dumps(SESSIONS)),
                 ("otel-metrics", json.dumps(POOL_METRICS))]
    out = process(bronze(rows))
    perf = {r.p: r["count"] for r in out.events.where("event_type = 'database_query'")
            .groupBy(F.col("tags")["performance"].alias("p")).count().collect()}
    assert perf == {"good": 5, "acceptable": 2, "slow": 2}
    assert out.events.where("event_type = 'log'").count() == 9 and out.metrics.count() == 36
    assert out.dead_letter.count() == 0
