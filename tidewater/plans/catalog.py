"""Registered queries: each reads the driver's tables and runs one operator.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
columns are named exactly like the DuckDB oracle in ``plans/oracle.py``.
Compared outputs flatten maps into columns and use ``timestamp_ntz``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.expr import vget
from tidewater.operators import analytics as an
from tidewater.operators import entities as ent
from tidewater.operators import joins as jn
from tidewater.operators import quality as qa
from tidewater.operators.metrics import MetricsProcessor
from tidewater.operators.processor import quarantine
from tidewater.operators.route import prepare, route_counts, routed, topic_prefilter
from tidewater.plans.pipeline import added_topics, default_processors, process, route_events, union_events
from tidewater.session import MESSAGE_CONF, TIDY_CONF, configure, settings, shared_dir
from tidewater.sinks import commit_log as log
from tidewater.sinks import lifecycle as life
from tidewater.sinks import tables as sk
from tidewater.sources import files as src
from tidewater.sources import testdata as td
from tidewater.sources.syslog import SYSLOG_TOPIC, syslog_events
from tidewater.streaming import stream as st

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def ntz(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark, MESSAGE_CONF)
    return td.load(spark, sf_dir, "events")


def _attr(name: str, typ: str = "string") -> Column:
    return vget(F.col("attributes")[name], typ)


# --- normalisation jobs -------------------------------------------------------

@register("normalize_queries")
def q_normalize_queries(spark, sf_dir):
    """FP6 + FP9 + SC1 + SC3: query-statistics envelopes → enriched events."""
    ev = route_events(td.query_messages(events_table(spark, sf_dir)), "queries")
    return ev.select(
        ntz("timestamp").alias("timestamp"), "entity_id", "event_type", "source", "environment",
        "message", _attr("query_hash").alias("query_hash"),
        F.col("tags")["performance"].alias("performance"),
        F.col("tags")["query_type"].alias("query_type"),
        _attr("calls", "bigint").alias("calls"),
        F.round(_attr("mean_time_ms", "double"), 4).alias("mean_time_ms"),
        "trace_id", "database")


# --- shared silver inputs -------------------------------------------------------


# Resource attributes the collector upserts on host logs (FP12).
COLLECTOR_RESOURCE = {"service.name": "otel-collector", "deployment.environment": "development"}


def query_events(spark, sf_dir):
    return route_events(td.query_messages(events_table(spark, sf_dir)), "queries")


def log_events(spark, sf_dir):
    return route_events(td.log_messages(events_table(spark, sf_dir)), "logs")


def host_log_events(spark, sf_dir):
    return route_events(td.otlp_log_messages(events_table(spark, sf_dir)), "host_logs")


def metric_rows(spark, sf_dir):
    return route_events(td.otlp_metric_messages(events_table(spark, sf_dir)), "metrics")


# Bytes of a row group of landed messages, before compression.
BRONZE_ROW_GROUP = 16 << 20
# Bytes of landed messages that one task parses: some 20 CPU seconds, so that the last tasks of a stage end together.
PARSE_SPLIT = {"spark.sql.files.maxPartitionBytes": str(9 << 20), "spark.sql.files.openCostInBytes": str(1 << 20)}


def land_bronze(spark, messages, path=None, deal=True):
    """Write the bronze messages once to the shared folder and read them back.

    Queries that need several routes (events of three kinds plus metrics) then
    scan landed messages per branch instead of rebuilding them per branch; the
    write also cuts the lineage. Every file holds an even share of each topic, as
    a scan deals out bytes, while a branch's work lies in its own topic; rows are
    sorted by topic so each branch's topic predicate skips (small) row groups of
    the other topics. ``deal=False`` is for messages of one route, whose tasks are even.
    """
    path = path or shared_dir(spark, "bronze")
    if deal:
        messages = messages.repartition("topic", "partition", "offset", "value").sortWithinPartitions("topic")
    with settings(spark, TIDY_CONF):
        (messages.write.mode("overwrite").option("compression", "zstd")
         .option("parquet.block.size", BRONZE_ROW_GROUP).parquet(path))
    return src.read_messages(spark, path)


def pipeline(spark, sf_dir, land=False):
    """All routes of the raw messages. ``land=True`` for queries that read both
    events and metrics (four or more route branches), where landing once is
    cheaper than rebuilding the messages per branch."""
    msgs = td.raw_messages(events_table(spark, sf_dir))
    return process(land_bronze(spark, msgs) if land else msgs)


# Folder of a session's stored tables by (application, input folder), and what has been written under it.
_stored: dict[tuple[str, str], str] = {}
_written: set[tuple[str, str]] = set()


# The parts of the stored tables, each of which is written when it is first read, and the routes that make them.
PARTS = {"events": {"database_query": ("queries",), "log": ("logs",), "syslog": ("host_logs", "syslog")},
         "metrics": {"metric": ("metrics",)}}


def _write_part(spark, sf_dir, base, name, part):
    """Land the messages that the part's routes read, unless it is written, and append their rows to its table."""
    bronze = f"{base}/bronze/{part}"
    if (base, part) in _written:
        src.read_messages(spark, bronze)  # fails where the shared folder has been emptied
        return
    routes, topics = PARTS[name][part], added_topics(default_processors())
    own = reduce(Column.__or__, [topic_prefilter(r, topics) for r in routes])
    messages = land_bronze(spark, td.raw_messages(events_table(spark, sf_dir)).where(own), bronze, deal=False)
    rows = [route_events(messages, r) for r in routes]
    if name == "events":
        sk.write_events(union_events(rows), f"{base}/events", split=PARSE_SPLIT)
    else:
        sk.write_metrics(reduce(DataFrame.unionByName, rows), f"{base}/metrics", split=PARSE_SPLIT)
    _written.add((base, part))


def stored(spark, sf_dir, *names, kind=None):
    """The tables ``names`` (by default events and metrics), read as the sinks have written them.

    The first query of a session over ``sf_dir`` that reads rows of a kind of event, or metrics, lands
    their messages and normalises them into the table; ``kind`` says that a query reads no other events.
    Later ones read what is there, as analyses do.
    """
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    names = names or tuple(PARTS)
    for _ in range(2):
        base = _stored.setdefault(key, shared_dir(spark, "stored"))
        try:
            for name in names:
                for part in PARTS[name]:
                    if kind in (None, part):
                        _write_part(spark, sf_dir, base, name, part)
            return tuple(sk.read_table(spark, f"{base}/{name}") for name in names)
        except AnalysisException:  # the shared folder has been emptied meanwhile
            del _stored[key]
        except Exception:  # a part may have been appended in part: start afresh next time
            del _stored[key]
            raise
    raise RuntimeError("the stored tables cannot be read back")


def stored_events(spark, sf_dir, kind=None, start=None, end=None):
    """Stored events, of one ``event_type`` or from a time on, by predicates that reach the scan."""
    stored(spark, sf_dir, "events", kind=kind)
    base = _stored[spark.sparkContext.applicationId, sf_dir]
    ev = sk.read_table(spark, f"{base}/events", start, end)
    return ev.where(F.col("event_type") == kind) if kind else ev


def stored_metrics(spark, sf_dir):
    return stored(spark, sf_dir, "metrics")[0]


def _r(c, n=4):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


# --- normalisation jobs (continued) -----------------------------------------------

@register("normalize_logs")
def q_normalize_logs(spark, sf_dir):
    """FP3 + FP4 + FP8: custom log envelopes → enriched log events."""
    ev = log_events(spark, sf_dir)
    t = F.col("tags")
    return ev.select(ntz("timestamp").alias("timestamp"), "entity_id", "event_type", "source",
                     "environment", "message", t["log_level"].alias("log_level"),
                     t["requires_alert"].alias("requires_alert"), t["category"].alias("category"),
                     "trace_id", "database")


@register("flatten_metrics")
def q_flatten_metrics(spark, sf_dir):
    """FP7 + FP10 + SC2/SC4/SC5/SC6: OTLP ResourceMetrics → metric rows."""
    m = metric_rows(spark, sf_dir)
    return m.select(ntz("timestamp").alias("timestamp"), "entity_id", "metric_name",
                    _r("metric_value").alias("metric_value"), "metric_type", "source", "environment",
                    "unit", F.col("tags")["severity"].alias("severity"),
                    F.col("tags")["database"].alias("database_tag"),
                    vget(F.col("metadata")["description"]).alias("description"))


@register("normalize_otlp_logs")
def q_normalize_otlp_logs(spark, sf_dir):
    """FP5 (all records, K2): OTLP logs → syslog events."""
    ev = host_log_events(spark, sf_dir)
    return ev.select(ntz("timestamp").alias("timestamp"), "entity_id", "event_type", "source",
                     "environment", "message", F.col("tags")["severity"].alias("severity"),
                     F.col("tags")["app"].alias("app"), "trace_id")


@register("syslog_events")
def q_syslog_events(spark, sf_dir):
    """SR6 + FP12 + SC12: RFC 3164 lines → syslog events with collector attributes."""
    ev = syslog_events(td.syslog_lines(events_table(spark, sf_dir)), COLLECTOR_RESOURCE)
    t = F.col("tags")
    return ev.select(ntz("timestamp").alias("timestamp"), "entity_id", "event_type", "environment",
                     "message", t["facility"].cast("int").alias("facility"),
                     t["severity"].cast("int").alias("severity"), t["appname"].alias("appname"),
                     t["proc_id"].alias("proc_id"), t["service.name"].alias("service_name"))


@register("route")
def q_route(spark, sf_dir):
    """FP1: messages per route, accepted and rejected."""
    return route_counts(prepare(td.raw_messages(events_table(spark, sf_dir))))


@register("dead_letter")
def q_dead_letter(spark, sf_dir):
    """FP2: rejected messages by topic, route and reason."""
    dl = pipeline(spark, sf_dir).dead_letter
    return dl.groupBy("topic", "route", "reason").agg(F.count(F.lit(1)).alias("messages"))


@register("unified_events")
def q_unified_events(spark, sf_dir):
    """UN1: logs, host logs and queries in one event stream."""
    ev = pipeline(spark, sf_dir).events
    return (ev.groupBy("event_type", "entity_id", "environment")
            .agg(F.count(F.lit(1)).alias("events"), ntz(F.min("timestamp")).alias("first_ts"),
                 ntz(F.max("timestamp")).alias("last_ts")))


def _entity_out(df):
    return df.select("entity_id", "entity_type", ntz("first_seen").alias("first_seen"),
                     ntz("last_seen").alias("last_seen"), "source", "environment", "records")


@register("derive_entities")
def q_derive_entities(spark, sf_dir):
    """AG2: one row per entity from events and metrics."""
    return _entity_out(ent.derive_entities(ent.entity_records(*stored(spark, sf_dir))))


@register("upsert_entities")
def q_upsert_entities(spark, sf_dir):
    """AG3 / ST10: entities of the second half merged into the stored ones of the first half."""
    rec = ent.entity_records(*stored(spark, sf_dir))
    cut = F.lit("2024-01-15").cast("timestamp")
    root = shared_dir(spark, "entity-store")
    for batch, part in enumerate((F.col("timestamp") < cut, F.col("timestamp") >= cut)):
        log.commit(spark, root, batch, {"entities": log.Upsert(
            ent.derive_entities(rec.where(part)), "entity_id", ent.upsert_entities)})
    return _entity_out(log.read(spark, root, "entities"))


@register("fingerprint_rollup")
def q_fingerprint_rollup(spark, sf_dir):
    """AG4: totals per query fingerprint."""
    r = an.fingerprint_rollup(stored_events(spark, sf_dir, "database_query"))
    return r.select("query_hash", "samples", "total_calls", _r("total_time_ms", 2).alias("total_time_ms"),
                    _r("max_mean_time_ms").alias("max_mean_time_ms"), "sample_query",
                    _r("weighted_mean_ms").alias("weighted_mean_ms"))


@register("derived_ratios")
def q_derived_ratios(spark, sf_dir):
    """AG5: cache-hit and commit ratios and backends per database, per entity and day.

    Backends and databases come from the session snapshots of each hour.
    """
    hours = _snapshots(spark, sf_dir).groupBy("host", "snapshot_ts").agg(
        F.sum("total").cast("double").alias("backends"), F.count(F.lit(1)).cast("double").alias("num_databases"))
    sessions = hours.select(
        F.col("host").alias("entity_id"), F.col("snapshot_ts").alias("timestamp"), F.explode(F.create_map(
            F.lit("postgresql.backends"), F.col("backends"),
            F.lit("postgresql.num_databases"), F.col("num_databases"))).alias("metric_name", "metric_value"))
    metrics = stored_metrics(spark, sf_dir).select("entity_id", "timestamp", "metric_name", "metric_value")
    r = an.derived_ratios(metrics.unionByName(sessions), "1 day")
    return r.select("entity_id", ntz("bucket").alias("bucket"), _r("blocks_hit").alias("blocks_hit"),
                    _r("blocks_read").alias("blocks_read"), _r("commits").alias("commits"),
                    _r("rollbacks").alias("rollbacks"), _r("cache_hit_ratio", 6).alias("cache_hit_ratio"),
                    _r("commit_ratio", 6).alias("commit_ratio"), _r("backends_per_db", 6).alias("backends_per_db"))


@register("rollup")
def q_rollup(spark, sf_dir):
    """AG6: hourly count/min/max/avg/sum per entity and metric."""
    r = an.rollup(stored_metrics(spark, sf_dir), "1 hour")
    return r.select(ntz("window_start").alias("window_start"), "entity_id", "metric_name", "samples",
                    _r("min_value").alias("min_value"), _r("max_value").alias("max_value"),
                    _r("avg_value", 6).alias("avg_value"), _r("sum_value").alias("sum_value"))


@register("regression")
def q_regression(spark, sf_dir):
    """AG7: daily buckets whose mean latency exceeds 1.5 × the earlier mean."""
    r = an.regression(stored_events(spark, sf_dir, "database_query"), "1 day", 1.5)
    return r.select("entity_id", "query_hash", ntz("bucket").alias("bucket"), "samples",
                    _r("current_mean", 6).alias("current_mean"),
                    _r("historical_mean", 6).alias("historical_mean"), _r("ratio", 6).alias("ratio"))


def _dbq(spark, sf_dir):
    return sk.db_queries(stored_events(spark, sf_dir, "database_query"))


@register("topk_total_time")
def q_topk_total_time(spark, sf_dir):
    """TK1 + FP21: the 20 most expensive statements by total time."""
    t = an.top_statements_by_total_time(_dbq(spark, sf_dir), 20)
    return t.select("host", ntz("timestamp").alias("timestamp"), "query_id", "query_text", "calls",
                    _r("total_time_ms").alias("total_time_ms"), _r("mean_time_ms").alias("mean_time_ms"))


@register("topk_calls")
def q_topk_calls(spark, sf_dir):
    """TK2: the 10 statements with the most calls."""
    t = an.top_statements_by_calls(_dbq(spark, sf_dir), 10)
    return t.select("host", ntz("timestamp").alias("timestamp"), "query_id", "calls",
                    _r("mean_time_ms").alias("mean_time_ms"))


@register("filter_entity_since")
def q_filter_entity_since(spark, sf_dir):
    """FP13."""
    ev = an.events_for_entity_since(stored_events(spark, sf_dir, start="2024-01-15"), "host-3", "2024-01-15")
    return ev.select(ntz("timestamp").alias("timestamp"), "entity_id", "event_type", "message")


@register("filter_source_type")
def q_filter_source_type(spark, sf_dir):
    """FP14."""
    ev = an.events_by_source_type(stored_events(spark, sf_dir), "postgresql", "database_query")
    return ev.groupBy("entity_id", "environment").agg(F.count(F.lit(1)).alias("events"))


@register("filter_metric_entity")
def q_filter_metric_entity(spark, sf_dir):
    """FP15."""
    m = an.metric_for_entity(stored_metrics(spark, sf_dir), "postgresql.commits", "host-2")
    return m.select(ntz("timestamp").alias("timestamp"), _r("metric_value").alias("metric_value"),
                    "environment")


@register("filter_time_between")
def q_filter_time_between(spark, sf_dir):
    """FP16."""
    between = ("2024-01-10 00:00:00", "2024-01-11 00:00:00")
    ev = an.time_range(stored_events(spark, sf_dir, None, *between), *between)
    return ev.select(ntz("timestamp").alias("timestamp"), "entity_id", "event_type", "message")


@register("filter_slow_1000")
def q_filter_slow_1000(spark, sf_dir):
    """FP17: slow rows of the typed query table."""
    d = an.slow_queries(_dbq(spark, sf_dir), 1000.0)
    return d.select("host", ntz("timestamp").alias("timestamp"), "query_id",
                    _r("mean_time_ms").alias("mean_time_ms"))


@register("filter_logs_combined")
def q_filter_logs_combined(spark, sf_dir):
    """FP17: time + host + level on the typed log table."""
    d = an.logs_combined(sk.db_logs(stored_events(spark, sf_dir, "log", "2024-01-20")), "2024-01-20", "host-1", "error")
    return d.select(ntz("timestamp").alias("timestamp"), "host", "database_name", "log_level", "message")


@register("filter_offset_range")
def q_filter_offset_range(spark, sf_dir):
    """FP18: explicit id range ``> 1000 AND < 2000``."""
    ev = an.id_range(td.query_messages(events_table(spark, sf_dir)), 1000, 2000, "offset")
    out = route_events(ev, "queries")
    return out.select(ntz("timestamp").alias("timestamp"), "entity_id", "message")


@register("filter_slow_queries")
def q_filter_slow_queries(spark, sf_dir):
    """FP19: mean above 100 ms."""
    d = an.slow_queries(_dbq(spark, sf_dir))
    return d.select("host", ntz("timestamp").alias("timestamp"), "query_id",
                    _r("mean_time_ms").alias("mean_time_ms"))


@register("filter_poor_cache")
def q_filter_poor_cache(spark, sf_dir):
    """FP19: cache hit ratio below 0.8."""
    d = an.poor_cache(_dbq(spark, sf_dir))
    return d.select("host", ntz("timestamp").alias("timestamp"), "query_id",
                    _r("cache_hit_ratio").alias("cache_hit_ratio"))


@register("filter_high_volume")
def q_filter_high_volume(spark, sf_dir):
    """FP19: more than 10,000 calls."""
    d = an.high_volume(_dbq(spark, sf_dir))
    return d.select("host", ntz("timestamp").alias("timestamp"), "query_id", "calls")


@register("filter_errors_deadlocks")
def q_filter_errors_deadlocks(spark, sf_dir):
    """FP20."""
    ev = an.errors_and_deadlocks(stored_events(spark, sf_dir))
    return ev.select(ntz("timestamp").alias("timestamp"), "entity_id", "log_level", "message")


@register("statement_shaping")
def q_statement_shaping(spark, sf_dir):
    """FP21: monitoring statements dropped, text cut to 500 chars, times as double."""
    d = an.shape_statements(_dbq(spark, sf_dir))
    return d.select("host", ntz("timestamp").alias("timestamp"), "query_id", "query_text",
                    _r("total_time_ms").alias("total_time_ms"), _r("mean_time_ms").alias("mean_time_ms"))


# --- joins --------------------------------------------------------------------------


@register("join_customer_orders")
def q_join_customer_orders(spark, sf_dir):
    """JN1: customers ⟕ orders, orders counted per customer name."""
    configure(spark)
    return jn.orders_per_customer(td.load(spark, sf_dir, "customer"), td.load(spark, sf_dir, "orders"))


@register("join_full_outer")
def q_join_full_outer(spark, sf_dir):
    """JN2: full outer equi-join of two sources."""
    configure(spark)
    c = td.load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = td.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    j = jn.full_outer(c, o, "c_custkey", "o_custkey")
    return j.select("c_custkey", "c_name", "o_orderkey", "o_custkey",
                    _r("o_totalprice", 2).alias("o_totalprice"))


@register("entity_lookup")
def q_entity_lookup(spark, sf_dir):
    """JN3: every event ⟕ the entities of events and metrics, counted per kind and entity type."""
    events, metrics = stored(spark, sf_dir)
    ents = ent.derive_entities(ent.entity_records(events, metrics))
    return (ent.entity_lookup(events, ents).groupBy("event_type", "entity_type")
            .agg(F.count(F.lit(1)).alias("events")))


@register("trace_correlation")
def q_trace_correlation(spark, sf_dir):
    """JN4: events grouped by shared trace id."""
    t = an.trace_correlation(stored_events(spark, sf_dir))
    return t.select("trace_id", "events", ntz("first_ts").alias("first_ts"),
                    ntz("last_ts").alias("last_ts"), "entities", "event_types")


# --- collector statistics -----------------------------------------------------------

def _snapshots(spark, sf_dir):
    act = td.activity_rows(events_table(spark, sf_dir))
    return an.filtered_counts(act, F.col("state"), ["host", "database", "snapshot_ts"],
                              deadlocks=F.count_if("deadlock"))


@register("filtered_counts")
def q_filtered_counts(spark, sf_dir):
    """AG1: total / active / idle sessions per host, database and hour."""
    act = td.activity_rows(events_table(spark, sf_dir))
    c = an.filtered_counts(act, F.col("state"), ["host", "database", "snapshot_ts"])
    return c.select("host", "database", ntz("snapshot_ts").alias("snapshot_ts"), "total", "active", "idle")


@register("stats_envelopes")
def q_stats_envelopes(spark, sf_dir):
    """FP23: statistics snapshots → log envelopes (read back from their JSON)."""
    snaps = (_snapshots(spark, sf_dir).withColumn("timestamp", F.col("snapshot_ts"))
             .withColumn("environment", F.lit("production")))
    env = qa.statistics_envelopes(snaps)
    frame = sk.keyed_frame(env, "raw-logs")
    j = lambda p: F.get_json_object("value", p)
    return frame.select(
        "key", j("$.host").alias("host"), j("$.database").alias("database"),
        j("$.timestamp").cast("timestamp").cast("timestamp_ntz").alias("timestamp"),
        j("$.tags.log_level").alias("log_level"), j("$.payload.event_type").alias("event_type"),
        j("$.payload.count").cast("double").alias("count"), j("$.payload.total").cast("double").alias("total"),
        j("$.payload.active").cast("double").alias("active"), j("$.payload.idle").cast("double").alias("idle"))


@register("envelope_completeness")
def q_envelope_completeness(spark, sf_dir):
    """FP22: per topic, bad JSON and missing envelope fields."""
    return qa.envelope_completeness(prepare(td.raw_messages(events_table(spark, sf_dir))))


# --- more aggregations ----------------------------------------------------------------

@register("topic_volume")
def q_topic_volume(spark, sf_dir):
    """AG8: messages and bytes per topic and hour, over the syslog lines."""
    lines = td.syslog_lines(events_table(spark, sf_dir)).withColumn("topic", F.lit(SYSLOG_TOPIC))
    v = an.topic_volume(lines, "1 hour")
    return v.select("topic", ntz("window_start").alias("window_start"), "messages", "total_bytes",
                    _r("mean_bytes", 4).alias("mean_bytes"))


@register("alert_rollup")
def q_alert_rollup(spark, sf_dir):
    """AG10: alerts per day, entity and rule."""
    r = an.alert_rollup(an.alert_rows(*stored(spark, sf_dir)), "1 day")
    return r.select(ntz("window_start").alias("window_start"), "entity_id", "rule", "alerts")


@register("row_count")
def q_row_count(spark, sf_dir):
    """AG11: rows of the silver tables."""
    events, metrics = stored(spark, sf_dir)
    return an.table_counts(events=events, metrics=metrics)


@register("dedup_by_id")
def q_dedup_by_id(spark, sf_dir):
    """WN1: replayed messages deduplicated on their deterministic id."""
    msgs = td.query_messages(events_table(spark, sf_dir))
    replayed = msgs.unionByName(msgs)  # every message delivered twice
    once = an.first_deliveries(replayed)  # copies go before the parse; ids catch what is left
    d = an.dedup_first(route_events(once, "queries"), "id", ("timestamp",))
    return d.select(ntz("timestamp").alias("timestamp"), "entity_id", "message", "trace_id")


# --- scans ------------------------------------------------------------------------------

@register("scan_limit")
def q_scan_limit(spark, sf_dir):
    """SR7: first rows of the events table in a deterministic order."""
    ev = stored_events(spark, sf_dir)
    t = an.top_k(ev, 5, [F.col("timestamp"), F.col("entity_id"), F.col("event_type"), F.col("message")])
    return t.select(ntz("timestamp").alias("timestamp"), "entity_id", "event_type", "message")


@register("syslog_scan_limit")
def q_syslog_scan_limit(spark, sf_dir):
    """SR8: predicate scan ``event_type = 'syslog'`` + limit."""
    ev = stored_events(spark, sf_dir, "syslog")
    t = an.top_k(ev, 5, [F.col("timestamp"), F.col("entity_id"), F.col("message")])
    return t.select(ntz("timestamp").alias("timestamp"), "entity_id", "event_type", "message")


@register("limit_any")
def q_limit_any(spark, sf_dir):
    """TK3: limit without order: how many rows came, and how many of them the table holds."""
    ev = stored_events(spark, sf_dir)
    some = ev.limit(5).select("id", "timestamp", "message")
    held = some.join(ev.select("id", "timestamp", "message").distinct(), ["id", "timestamp", "message"], "left_semi")
    return an.table_counts(returned=some, held=held)


# --- typed projections, retention, insert-if-absent, fan-out ----------------------------------

@register("db_queries_view")
def q_db_queries_view(spark, sf_dir):
    """SK8: typed ``db_queries``."""
    d = _dbq(spark, sf_dir)
    return d.select(ntz("timestamp").alias("timestamp"), "host", "database_name",
                    _r("mean_time_ms").alias("mean_time_ms"), "source", "environment", "query_id",
                    "query_text", "query_hash", "calls", _r("total_time_ms").alias("total_time_ms"),
                    _r("cache_hit_ratio").alias("cache_hit_ratio"))


@register("db_logs_view")
def q_db_logs_view(spark, sf_dir):
    """SK8: typed ``db_logs``."""
    d = sk.db_logs(stored_events(spark, sf_dir, "log"))
    return d.select(ntz("timestamp").alias("timestamp"), "host", "database_name", "log_level", "source",
                    "environment", "event_type", "message")


@register("db_metrics_view")
def q_db_metrics_view(spark, sf_dir):
    """SK8: typed ``db_metrics``."""
    d = sk.db_metrics(stored_metrics(spark, sf_dir))
    return d.select(ntz("timestamp").alias("timestamp"), "host", "database_name", "metric_name", "source",
                    "environment", _r("metric_value").alias("metric_value"), "metric_type", "unit")


@register("retention")
def q_retention(spark, sf_dir):
    """SK10: messages kept by per-topic retention as of 2024-01-30."""
    kept = an.retention(td.raw_messages(events_table(spark, sf_dir)), "2024-01-30")
    return kept.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@register("retention_table")
def q_retention_table(spark, sf_dir):
    """SK10 on a stored table: whole days dropped by metadata, the day of the cut filtered by time."""
    table = f"{_schema(spark, 'ageing')}.messages"
    life.store_messages(td.raw_messages(events_table(spark, sf_dir)), table)
    kept, dropped = life.age_messages(spark, table, "2024-01-30 12:00:00")
    days = spark.createDataFrame(list(dropped.items()), "topic string, dropped_days long")
    return (kept.groupBy("topic").agg(F.count(F.lit(1)).alias("messages")).join(days, "topic", "left")
            .select("topic", "messages", F.coalesce("dropped_days", F.lit(0)).alias("dropped_days")))


@register("insert_if_absent")
def q_insert_if_absent(spark, sf_dir):
    """SK11: new query events whose id the stored table does not hold yet; only their days are read."""
    ev = stored_events(spark, sf_dir, "database_query")
    path = shared_dir(spark, "known-events")
    (ev.where(F.col("timestamp") < F.lit("2024-01-20").cast("timestamp"))
     .repartition("event_date").write.partitionBy("event_date").parquet(path))
    new = ev.where(F.col("timestamp") >= F.lit("2024-01-10").cast("timestamp"))
    ins = life.absent_rows(sk.read_table(spark, path), new)
    return ins.select("entity_id", ntz("timestamp").alias("timestamp"), "message")


def _schema(spark, name):
    """A schema of its own for one run, its tables in the shared folder."""
    schema = f"{name}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{shared_dir(spark, name)}'")
    return schema


@register("table_lifecycle")
def q_table_lifecycle(spark, sf_dir):
    """SK6 / SK7: tables created by DDL and filled, then recreated (an old one goes too) and filled again."""
    events, metrics = stored(spark, sf_dir)
    entities = ent.entities_json(ent.derive_entities(ent.entity_records(events, metrics)))
    schema = _schema(spark, "lifecycle")
    for other in ("db_logs", "notes"):
        spark.sql(f"CREATE TABLE {schema}.{other} (line string) USING parquet")
    for recreate in (False, True):
        life.create_tables(spark, schema, recreate=recreate)
        for name, rows in (("events", events), ("metrics", metrics), ("entities", entities)):
            life.insert(rows, schema, name)
    names = life.list_tables(spark, schema)
    counts = an.table_counts(**{n: spark.table(f"{schema}.{n}") for n in names})
    return (spark.createDataFrame([(n,) for n in names], "table_name string").join(counts, "table_name", "left")
            .select("table_name", F.coalesce("row_count", F.lit(0)).alias("row_count")))


@register("document_metrics")
def q_document_metrics(spark, sf_dir):
    """SR4: messages as large JSON arrays, several messages to a file, cut at their elements and flattened."""
    path = shared_dir(spark, "documents")
    td.otlp_metric_messages(events_table(spark, sf_dir)).select("value").mapInArrow(
        td.json_array_lines, "value string").write.text(path)
    return q_flatten_metrics_from(route_events(src.read_json_documents(spark, path, "otel-metrics"), "metrics"))


@register("processed_topics")
def q_processed_topics(spark, sf_dir):
    """SK9: processed rows fanned out to their output topics."""
    events, metrics = stored(spark, sf_dir)
    kind = F.when(F.col("event_type") == "database_query", "queries").otherwise("logs")
    ev = events.select(sk.processed_topic(kind).alias("topic"))
    mt = metrics.select(sk.processed_topic(F.lit("metrics")).alias("topic"))
    al = an.alert_rows(events, metrics).select(sk.processed_topic(F.lit("alerts")).alias("topic"))
    return ev.unionByName(mt).unionByName(al).groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@register("validation_report")
def q_validation_report(spark, sf_dir):
    """FP11: rows of each table that break a rule are kept apart; the metrics of error events come again as NaN."""
    ev = events_table(spark, sf_dir)
    dirty = td.otlp_metric_messages(ev.where(F.col("event_type") == "error")).select(
        "topic", "partition", (F.col("offset") + (1 << 40)).alias("offset"), "key",
        F.regexp_replace("value", r'"as_double":[0-9.eE+-]+', '"as_double":"NaN"').alias("value"), "ingest_ts")
    out = process(land_bronze(spark, td.raw_messages(ev).unionByName(dirty)))
    rows = []
    for name, frame in (("events", out.events), ("metrics", out.metrics)):
        clean, invalid = quarantine(frame)
        rows += [clean.select(F.lit(name).alias("table_name"), F.lit(None).cast("string").alias("violation")),
                 invalid.select(F.lit(name).alias("table_name"), F.explode("violations").alias("violation"))]
    return (reduce(DataFrame.unionByName, rows).groupBy("table_name", "violation")
            .agg(F.count(F.lit(1)).alias("row_count")))


# --- streaming (run to completion with availableNow, results read back) -----------------


# Bytes of a landed file that a stream takes a fixed number of: a micro-batch has some 10 s of its own, so its
# files hold minutes of messages, not the share of one task and topic.
STREAM_FILES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(8 << 20)}


def _bronze_files(spark, sf_dir, name, messages):
    """Land bronze messages as Parquet files in the shared folder (the stream's input)."""
    path = shared_dir(spark, name)
    messages.write.mode("overwrite").parquet(path)
    return path


@register("stream_normalize")
def q_stream_normalize(spark, sf_dir):
    """ST1/ST3/ST5/SK4: bronze file stream → foreachBatch normalisation → events table."""
    bronze = shared_dir(spark, "bronze")
    with settings(spark, STREAM_FILES):
        land_bronze(spark, td.raw_messages(events_table(spark, sf_dir)), bronze)
    out = shared_dir(spark, "silver")
    q = st.start_normalisation(src.read_messages_stream(spark, bronze, max_files_per_trigger=16),
                               out, os.path.join(out, "_checkpoint"), available_now=True)
    q.awaitTermination()
    events = log.read(spark, out, "events")
    return events.groupBy("event_type", "entity_id").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("id").alias("ids"),
        ntz(F.min("timestamp")).alias("first_ts"), F.sum(F.length("message")).alias("message_chars"))


@register("stream_window_rollup")
def q_stream_window_rollup(spark, sf_dir):
    """ST6: hourly metric windows with a 10-minute watermark, append mode (closed windows only)."""
    ev = events_table(spark, sf_dir)
    bronze = _bronze_files(spark, sf_dir, "bronze-metrics", td.otlp_metric_messages(ev))
    metrics = route_events(src.read_messages_stream(spark, bronze), "metrics")
    w = st.windowed_metrics(metrics, "1 hour", None, "10 minutes")
    out, _ = st.run_to_table(w, shared_dir(spark, "rollup-ckpt"))
    return out.select(ntz("window_start").alias("window_start"), "entity_id", "metric_name", "samples",
                      _r("min_value").alias("min_value"), _r("max_value").alias("max_value"),
                      _r("sum_value").alias("sum_value"))


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """ST7: replayed query messages dropped within the watermark."""
    msgs = td.query_messages(events_table(spark, sf_dir))
    bronze = _bronze_files(spark, sf_dir, "bronze-replay",
                           msgs.unionByName(msgs))  # every message delivered twice
    ev = route_events(src.read_messages_stream(spark, bronze), "queries")
    d = st.dedup_stream(ev.select("id", "timestamp", "entity_id", "message", "trace_id"))
    out, _ = st.run_to_table(d, shared_dir(spark, "dedup-ckpt"))
    return out.select(ntz("timestamp").alias("timestamp"), "entity_id", "message", "trace_id")


def _restarted(spark, name, halves, start):
    """Drain ``start(stream, out, checkpoint)`` over the first half of some messages, land the second, start again."""
    bronze, out = shared_dir(spark, f"{name}-bronze"), shared_dir(spark, name)
    for half in halves:
        half.write.mode("append").parquet(bronze)
        start(src.read_messages_stream(spark, bronze), out, out + "-checkpoint").awaitTermination()
    return out


def _halves(messages):
    at = F.lit("2024-01-15").cast("timestamp")
    return messages.where(F.col("ingest_ts") < at), messages.where(F.col("ingest_ts") >= at)


def _alert_topics(spark, sf_dir):
    landed = land_bronze(spark, td.raw_messages(events_table(spark, sf_dir)))
    return _restarted(spark, "alerts", _halves(landed), lambda stream, out, checkpoint: st.start_alerts(
        stream, out, checkpoint, available_now=True))


@register("slow_query_stream")
def q_slow_query_stream(spark, sf_dir):
    """ST9: a stream of slow queries (> 100 ms) keyed host:database, stopped and started again, per key."""
    s = log.read(spark, _alert_topics(spark, sf_dir), "slow_queries")
    field = lambda name, kind: F.get_json_object("value", f"$.{name}").cast(kind)
    return s.groupBy("topic", "key").agg(F.count(F.lit(1)).alias("messages"),
                                         _r(F.max(field("mean_time_ms", "double"))).alias("slowest_ms"),
                                         F.max(field("time_us", "bigint")).alias("last_us"))


@register("alert_stream")
def q_alert_stream(spark, sf_dir):
    """ST8: a stream of alerts keyed host:database, stopped and started again, per key and rule."""
    a = log.read(spark, _alert_topics(spark, sf_dir), "alerts")
    return (a.select("topic", "key", F.get_json_object("value", "$.rule").alias("rule"))
            .groupBy("topic", "key", "rule").agg(F.count(F.lit(1)).alias("messages")))


@register("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """ST7: a stream that gets its second half's events twice and then its first half, too late:
    rows kept, late and double add up to the rows read."""
    early, recent = _halves(td.query_messages(events_table(spark, sf_dir)))
    bronze, checkpoint = shared_dir(spark, "late-bronze"), shared_dir(spark, "late-checkpoint")
    counted = []
    for part in (recent.unionByName(recent), early):
        part.write.mode("append").parquet(bronze)
        ev = route_events(src.read_messages_stream(spark, bronze), "queries")
        out, query = st.run_to_table(st.dedup_stream(ev.select("id", "timestamp")), checkpoint)
        counted += st.progress_rows(query)
    rows = spark.createDataFrame(counted, "batch_id long, read long, late long, doubles long")
    kept = out.agg(F.count(F.lit(1)).alias("kept"))
    return kept.crossJoin(rows.agg(F.sum("late").alias("late"), F.sum("doubles").alias("doubles")))


@register("table_roundtrip")
def q_table_roundtrip(spark, sf_dir):
    """SK1/SK2/SK6 + FP16 read helper: write sorted, date-partitioned tables; read a day range back."""
    bronze = shared_dir(spark, "bronze")
    messages = land_bronze(spark, td.raw_messages(events_table(spark, sf_dir)), bronze)
    out = process(messages)
    base = shared_dir(spark, "tables")
    sk.write_events(out.events, os.path.join(base, "events"), mode="overwrite", split=PARSE_SPLIT)
    sk.write_metrics(out.metrics, os.path.join(base, "metrics"), mode="overwrite", split=PARSE_SPLIT)
    sk.drop_rows(spark, bronze, messages.schema)  # what is read back below are the tables
    ev = sk.read_table(spark, os.path.join(base, "events"), "2024-01-05 00:00:00", "2024-01-12 23:59:59")
    mt = spark.read.parquet(os.path.join(base, "metrics"))
    a = ev.groupBy("event_date", "event_type").agg(
        F.count(F.lit(1)).alias("rows_read"), F.sum(F.length("message")).alias("chars"),
        _r(F.sum("mean_time_ms"), 2).alias("amount"))
    b = (mt.where(F.col("event_date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-12").cast("date")))
         .groupBy("event_date").agg(F.count(F.lit(1)).alias("rows_read"), F.sum(F.length("unit")).alias("chars"),
                                    _r(F.sum("metric_value"), 2).alias("amount"))
         .withColumn("event_type", F.lit("metric")))
    return a.unionByName(b).select(F.col("event_date").cast("string").alias("event_date"), "event_type",
                                   "rows_read", "chars", "amount")


@register("entities_table")
def q_entities_table(spark, sf_dir):
    """SK3/SK7: entities written in the contract shape (replacing the old set) and read back."""
    path = shared_dir(spark, "entities")
    sk.write_entities(ent.entities_json(ent.derive_entities(ent.entity_records(*stored(spark, sf_dir)))), path)
    e = spark.read.parquet(path)
    return e.select("entity_id", "entity_type", ntz("first_seen").alias("first_seen"),
                    ntz("last_seen").alias("last_seen"),
                    F.get_json_object("attributes", "$.source_system").alias("source"),
                    F.get_json_object("attributes", "$.environment").alias("environment"),
                    F.get_json_object("attributes", "$.records").cast("bigint").alias("records"))


@register("protobuf_metrics")
def q_protobuf_metrics(spark, sf_dir):
    """SR3: OTLP protobuf requests (half gzip) decoded, then flattened like FP7."""
    from tidewater.sources import otlp_proto
    msgs = td.otlp_metric_messages(events_table(spark, sf_dir))
    decoded = otlp_proto.decode_messages(otlp_proto.encode_messages(msgs))
    return q_flatten_metrics_from(route_events(decoded, "metrics"))


def q_flatten_metrics_from(m):
    return m.select(ntz("timestamp").alias("timestamp"), "entity_id", "metric_name",
                    _r("metric_value").alias("metric_value"), "metric_type", "source", "environment",
                    "unit", F.col("tags")["severity"].alias("severity"),
                    F.col("tags")["database"].alias("database_tag"),
                    vget(F.col("metadata")["description"]).alias("description"))


@register("join_text_table")
def q_join_text_table(spark, sf_dir):
    """SR9 + JN2: orders as a '|'-delimited text table with declared columns,
    full outer joined with the Parquet customer table (two sources)."""
    configure(spark)
    path = shared_dir(spark, "orders-text")
    (td.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
     .write.mode("overwrite").option("sep", "|").csv(path))
    o = src.read_delimited(spark, path, "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, "
                                        "o_orderdate TIMESTAMP_NTZ", sep="|")
    c = td.load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = jn.full_outer(c, o, "c_custkey", "o_custkey")
    return j.select("c_custkey", "c_name", "o_orderkey", "o_custkey",
                    _r("o_totalprice", 2).alias("o_totalprice"))


@register("collector_resource_metrics")
def q_collector_resource_metrics(spark, sf_dir):
    """FP12 on metrics: the collector's resource upsert applied before flattening."""
    msgs = td.otlp_metric_messages(events_table(spark, sf_dir))
    m = MetricsProcessor(resource_upserts=COLLECTOR_RESOURCE).process(routed(prepare(msgs), "metrics"))
    return q_flatten_metrics_from(m)
