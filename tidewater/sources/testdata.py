"""Adapter: the driver's ``events`` table → raw telemetry messages.

Each ``events`` row is turned, with DataFrame expressions only, into the
message shapes the pipeline consumes: a custom log envelope, a query-statistics
envelope, one OTLP metric data point, one OTLP log record and one RFC 3164
syslog line. OTLP points/records are nested into messages per
``(user, 1000-id chunk)``, so a message never holds more than 1000 rows even if
one user owns a third of the table. The rules below are mirrored by the DuckDB
oracle SQL, which computes expected results from ``events`` without ever
seeing JSON.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapter (the oracle SQL repeats them).
QUERY_TEXTS = [
    "SELECT * FROM users WHERE id = $1",
    "INSERT INTO orders (user_id, total_amount) VALUES ($1, $2)",
    "DELETE FROM sessions WHERE expires_at < now()",
    "CREATE INDEX idx_orders_user ON orders (user_id)",
    "CREATE TABLE audit_log (id serial, note text, updated_at timestamp)",
    "  select   COUNT(*)\n  FROM Orders\tWHERE  status = $1 ",
    "SELECT * FROM pg_stat_activity WHERE state = $1",
]
METRIC_NAMES = {
    "view": "postgresql.blocks_read",
    "click": "postgresql.blocks_hit",
    "purchase": "postgresql.commits",
    "signup": "postgresql.rollbacks",
    "error": "app.error.count",
}
METRIC_UNITS = {"view": "blocks", "click": "blocks", "purchase": "commits",
                "signup": "rollbacks", "error": "errors"}
SYSLOG_TAGS = ["nginx", "chronyd", "systemd", "dockerd"]
CHUNK = 1000          # event ids per OTLP message group
NOT_JSON_MOD = 97     # truncated JSON
NULL_PAYLOAD_MOD = 101
BAD_TS_MOD = 89       # unparseable timestamp → ingest time
ZULU_TS_MOD = 11      # 'Z' suffix
NO_TOPIC_MOD = 17     # topic missing → routed by content
NO_QUERY_MOD = 13     # payload without query text
INGEST_LAG_SECONDS = 2


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(key: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v)))
    return out.otherwise(F.lit(default))


def _base(events: DataFrame, *by: str) -> DataFrame:
    """Columns every message shape uses.

    Rows are dealt out by id (or ``by`` the columns they are grouped by later, which then need
    no other shuffle) first: an ``events`` file of one row group would otherwise
    put the whole JSON work into one task, and these rows are much slimmer than their messages.
    For that reason the number of tasks is stated: left to AQE, which sizes them by the slim
    rows, all envelopes of a topic end up in one.
    """
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    events = events.withColumn("chunk", F.floor(F.col("event_id") / CHUNK)).repartition(n, *(by or ["event_id"]))
    eid, uid = F.col("event_id"), F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return events.select(
        "event_id", "user_id", "chunk", "event_type", "value", "props",
        ts.alias("ts"),
        (ts + F.expr(f"INTERVAL {INGEST_LAG_SECONDS} SECONDS")).alias("ingest_ts"),
        F.concat(F.lit("host-"), (uid % 7).cast("string")).alias("host"),
        F.concat(F.lit("db-"), (uid % 3).cast("string")).alias("database"),
        F.when(eid % 3 == 1, "staging").when(eid % 3 == 2, "development").alias("environment"),
        F.when(eid % BAD_TS_MOD == 0, F.lit("not-a-time"))
         .when(eid % ZULU_TS_MOD == 0, F.concat(iso, F.lit("Z")))
         .otherwise(iso).alias("ts_text"),
        F.concat(F.lit("t-"), F.floor(eid / 5).cast("string")).alias("trace_id"),
    )


def _envelope(b: DataFrame, topic: str, data_type: str, tags: Column,
              payload: Column) -> DataFrame:
    """Custom JSON envelope with the dirty-row rules applied."""
    eid = F.col("event_id")
    head = F.to_json(F.struct(
        F.col("ts_text").alias("timestamp"), F.lit("postgresql").alias("source"),
        F.lit(data_type).alias("data_type"), F.col("host"), F.col("database"),
        F.col("environment"), tags.alias("tags")))
    body = F.concat(F.expr("substring(" + "__h" + ", 1, length(__h) - 1)"),
                    F.lit(',"payload":'),
                    F.when(eid % NULL_PAYLOAD_MOD == 0, F.lit("null")).otherwise(F.to_json(payload)),
                    F.lit("}"))
    return (b.withColumn("__h", head)
             .select(
                 F.when(eid % NO_TOPIC_MOD == 0, F.lit("")).otherwise(F.lit(topic)).alias("topic"),
                 (F.col("user_id") % 4).cast("int").alias("partition"),
                 eid.alias("offset"),
                 F.concat_ws(":", "host", "database").alias("key"),
                 F.when(eid % NOT_JSON_MOD == 0, F.substring(body, 1, 25)).otherwise(body).alias("value"),
                 "ingest_ts"))


def query_messages(events: DataFrame) -> DataFrame:
    """``raw-queries`` envelopes (query statistics)."""
    b = _base(events)
    eid = F.col("event_id")
    calls = (F.lit(1) + (eid * 7919) % 20000).cast("bigint")
    mean = F.col("value") * 10
    text = F.element_at(F.array(*[F.lit(t) for t in QUERY_TEXTS]),
                        (eid % len(QUERY_TEXTS) + 1).cast("int"))
    payload = F.struct(
        F.concat(F.lit("q"), (eid % len(QUERY_TEXTS)).cast("string")).alias("queryid"),
        F.when(eid % NO_QUERY_MOD != 0, text).alias("query"),
        calls.alias("calls"),
        (calls * mean).alias("total_time_ms"),
        mean.alias("mean_time_ms"),
        ((eid % 100) / 100.0).alias("cache_hit_ratio"),
        F.col("trace_id"))
    return _envelope(b, "raw-queries", "query", F.struct(), payload)


def log_messages(events: DataFrame) -> DataFrame:
    """``raw-logs`` envelopes (collector log events)."""
    b = _base(events)
    eid, et = F.col("event_id"), F.col("event_type")
    log_level = (F.when(et == "error", F.when(eid % 4 == 0, "critical").otherwise("error"))
                 .when(et == "signup", "warning").when(et == "view", F.lit(None))
                 .otherwise("info"))
    payload = F.struct(
        _case(et, {"error": "query_error", "signup": "deadlocks",
                   "purchase": "connection_stats", "click": "checkpoint"}).alias("event_type"),
        F.when(et == "error", F.concat(F.lit("E"), (eid % 50).cast("string"))).alias("error_code"),
        F.when((et == "error") & (eid % 2 == 0),
               F.concat(F.lit("relation r"), F.col("user_id").cast("string"), F.lit(" missing"))
               ).alias("error_message"),
        F.when(et == "signup", eid % 5).alias("count"),
        F.when(et == "purchase", F.lit(20)).alias("total"),
        F.when(et == "purchase", eid % 10).alias("active"),
        F.when(et == "purchase", 20 - eid % 10).alias("idle"),
        F.col("trace_id"))
    return _envelope(b, "raw-logs", "log", F.struct(log_level.alias("log_level")), payload)


def _attr(key: str, value: Column, camel: Column, kind: str = "string") -> Column:
    """One OTLP attribute; camelCase or snake_case value spelling per row."""
    def put(want_kind, want_camel):
        cond = camel if want_camel else ~camel
        return F.when(cond, value) if kind == want_kind else F.lit(None).cast("string")
    return F.struct(F.lit(key).alias("key"), F.struct(
        put("string", True).alias("stringValue"), put("string", False).alias("string_value"),
        put("int", True).alias("intValue"), put("int", False).alias("int_value")).alias("value"))


def _resource(b: DataFrame, with_pid: bool) -> Column:
    uid = F.col("user_id")
    camel = (uid % 2 == 0)
    env = F.when(uid % 3 == 0, "production").when(uid % 3 == 1, "staging").otherwise("development")
    attrs = [
        _attr("host.name", F.col("host"), camel),
        _attr("db.system", F.lit("postgresql"), camel),
        _attr("deployment.environment", env, camel),
    ]
    if with_pid:
        attrs.append(_attr("process.pid", uid.cast("string"), camel, kind="int"))
    arr = F.array(*attrs)
    # resources of every tenth user carry no host name
    return F.when(uid % 10 == 9, F.filter(arr, lambda a: a["key"] != "host.name")).otherwise(arr)


def otlp_metric_messages(events: DataFrame) -> DataFrame:
    """``otel-metrics`` messages: one ResourceMetrics object (JSON) per user and id chunk."""
    b = _base(events, "user_id", "chunk")
    et = F.col("event_type")
    gauge = et.isin("view", "click")
    point = F.struct(
        (F.unix_micros("ts") * 1000).cast("string").alias("time_unix_nano"),
        F.when(gauge, F.floor("value").cast("bigint").cast("string")).alias("as_int"),
        F.when(~gauge, F.col("value")).alias("as_double"),
        F.array(F.struct(F.lit("database").alias("key"),
                         F.struct(F.col("database").alias("stringValue")).alias("value"))).alias("attributes"))
    pts = (b.select("user_id", "host", "chunk",
                    F.col("event_id"), F.col("ingest_ts"),
                    _case(et, METRIC_NAMES).alias("name"),
                    _case(et, METRIC_UNITS).alias("unit"),
                    gauge.alias("is_gauge"), point.alias("pt"))
           .groupBy("user_id", "host", "chunk", "name", "unit", "is_gauge")
           .agg(F.collect_list("pt").alias("pts"), F.min("event_id").alias("first_id"),
                F.max("ingest_ts").alias("ingest_ts")))
    metric = F.struct(
        F.col("name"), F.concat(F.lit("Synthetic "), F.col("name")).alias("description"), F.col("unit"),
        F.when(F.col("is_gauge"), F.struct(F.col("pts").alias("data_points"))).alias("gauge"),
        F.when(~F.col("is_gauge"), F.struct(F.col("pts").alias("data_points"))).alias("sum"))
    msgs = (pts.select("user_id", "host", "chunk", "first_id", "ingest_ts", metric.alias("m"))
            .groupBy("user_id", "host", "chunk")
            .agg(F.collect_list("m").alias("metrics"), F.min("first_id").alias("first_id"),
                 F.max("ingest_ts").alias("ingest_ts")))
    value = F.to_json(F.struct(
        F.struct(_resource(msgs, True).alias("attributes")).alias("resource"),
        F.array(F.struct(F.struct(F.lit("postgresql").alias("name"),
                                  F.lit("1.0").alias("version")).alias("scope"),
                         F.col("metrics").alias("metrics"))).alias("scope_metrics")))
    return msgs.select(F.lit("otel-metrics").alias("topic"),
                       (F.col("user_id") % 4).cast("int").alias("partition"),
                       F.col("first_id").alias("offset"),
                       F.col("host").alias("key"), value.alias("value"), "ingest_ts")


def json_array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's messages as the lines of one JSON array."""
    first = True
    for b in batches:
        lines = [("[" if first and not i else ",") + v for i, v in enumerate(b.column(0).to_pylist())]
        first = first and not lines
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], ["value"])


def otlp_log_messages(events: DataFrame) -> DataFrame:
    """``raw-host-logs`` messages: OTLP JSON logs, many records per message."""
    b = _base(events, "user_id", "chunk")
    et, eid = F.col("event_type"), F.col("event_id")
    record = F.struct(
        (F.unix_micros("ts") * 1000).cast("string").alias("timeUnixNano"),
        F.when(et != "view", F.struct(F.concat_ws(" ", et, F.lit("from user"),
                                                  F.col("user_id").cast("string"),
                                                  F.col("props")).alias("stringValue"))).alias("body"),
        F.array(
            F.struct(F.lit("severity").alias("key"),
                     F.struct(F.when(et == "error", "err").otherwise("info").alias("stringValue")).alias("value")),
            F.struct(F.lit("app").alias("key"), F.struct(F.lit(None).cast("string").alias("stringValue")).alias("value")),
        ).alias("attributes"),
        F.when(et == "click", F.col("trace_id")).alias("traceId"))
    msgs = (b.select("user_id", "host", "chunk", eid, "ingest_ts",
                     record.alias("r"))
            .groupBy("user_id", "host", "chunk")
            .agg(F.collect_list("r").alias("records"), F.min("event_id").alias("first_id"),
                 F.max("ingest_ts").alias("ingest_ts")))
    value = F.to_json(F.struct(F.array(F.struct(
        F.struct(_resource(msgs, False).alias("attributes")).alias("resource"),
        F.array(F.struct(F.struct(F.lit("syslog").alias("name")).alias("scope"),
                         F.col("records").alias("logRecords"))).alias("scopeLogs"))).alias("resourceLogs")))
    return msgs.select(F.lit("raw-host-logs").alias("topic"),
                       (F.col("user_id") % 4).cast("int").alias("partition"),
                       F.col("first_id").alias("offset"),
                       F.col("host").alias("key"), value.alias("value"), "ingest_ts")


def syslog_lines(events: DataFrame) -> DataFrame:
    """RFC 3164 lines ``<PRI>Mmm dd HH:MM:SS host tag[pid]: msg`` with ``ingest_ts``."""
    b = _base(events)
    eid = F.col("event_id")
    tag = F.element_at(F.array(*[F.lit(t) for t in SYSLOG_TAGS]), (eid % 4 + 1).cast("int"))
    proc = F.when(eid % 4 == 2, F.lit("")).otherwise(
        F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit("]")))
    line = F.concat(F.lit("<"), (eid % 192).cast("string"), F.lit(">"),
                    F.date_format("ts", "MMM dd HH:mm:ss"), F.lit(" "), F.col("host"), F.lit(" "),
                    tag, proc, F.lit(": "), F.col("event_type"), F.lit(" "), F.col("props"))
    return b.select(eid.alias("offset"), line.alias("value"), "ingest_ts")


def raw_messages(events: DataFrame) -> DataFrame:
    """All four JSON topics in one bronze DataFrame."""
    return (query_messages(events)
            .unionByName(log_messages(events))
            .unionByName(otlp_metric_messages(events))
            .unionByName(otlp_log_messages(events)))


def activity_rows(events: DataFrame) -> DataFrame:
    """Session-activity rows (a ``pg_stat_activity`` stand-in) with an hourly snapshot time."""
    b = _base(events)
    et = F.col("event_type")
    state = _case(et, {"purchase": "active", "view": "idle", "click": "idle in transaction"})
    return b.select("host", "database", F.date_trunc("hour", "ts").alias("snapshot_ts"),
                    state.alias("state"), (et == "error").alias("deadlock"))
