"""DuckDB oracle SQL for every registered query.

The oracle never sees JSON: it recomputes, straight from ``events``, what the
adapter encodes into messages and what each operator should produce.
"""

from __future__ import annotations

from tidewater.sources import testdata as td


def _sql_str(s: str) -> str:
    """Python text → SQL string expression (control characters via chr)."""
    parts, buf = [], ""
    for ch in s:
        if ch in "\n\t":
            parts.append("'" + buf.replace("'", "''") + "'")
            parts.append(f"chr({ord(ch)})")
            buf = ""
        else:
            buf += ch
    parts.append("'" + buf.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def _case(key: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {key} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


QUERY_TEXT = ("CASE event_id % {n} ".format(n=len(td.QUERY_TEXTS))
              + " ".join(f"WHEN {i} THEN {_sql_str(t)}" for i, t in enumerate(td.QUERY_TEXTS))
              + " END")

# The adapter's rules, as columns over ``events``.
BASE = f"""
b AS (
  SELECT event_id, user_id, event_type, value, props, ts,
    'host-' || CAST(user_id % 7 AS VARCHAR) AS host,
    'db-' || CAST(user_id % 3 AS VARCHAR) AS database,
    CASE event_id % 3 WHEN 1 THEN 'staging' WHEN 2 THEN 'development' ELSE 'production' END AS environment,
    CASE WHEN event_id % {td.BAD_TS_MOD} = 0 THEN ts + INTERVAL {td.INGEST_LAG_SECONDS} SECOND ELSE ts END AS env_ts,
    ts + INTERVAL {td.INGEST_LAG_SECONDS} SECOND AS ingest_ts,
    't-' || CAST(event_id // 5 AS VARCHAR) AS trace_id,
    (event_id % {td.NOT_JSON_MOD} = 0) AS not_json,
    (event_id % {td.NOT_JSON_MOD} <> 0 AND event_id % {td.NULL_PAYLOAD_MOD} = 0) AS null_payload,
    (event_id % {td.NOT_JSON_MOD} <> 0 AND event_id % {td.NULL_PAYLOAD_MOD} <> 0) AS ok
  FROM events
)"""

# Query-statistics events (FP6 + FP9) before the dead-letter filter.
QROWS = f"""
qr AS (
  SELECT b.*,
    CASE WHEN event_id % {td.NO_QUERY_MOD} <> 0 THEN {QUERY_TEXT} END AS query,
    CAST(1 + (event_id * 7919) % 20000 AS BIGINT) AS calls,
    value * 10 AS mean_time_ms,
    (event_id % 100) / 100.0 AS cache_hit_ratio
  FROM b
),
q AS (
  SELECT qr.*,
    substr(sha256(trim(regexp_replace(lower(query), '\\s+', ' ', 'g'))), 1, 16) AS query_hash,
    CASE WHEN mean_time_ms > 1000 THEN 'slow' WHEN mean_time_ms > 100 THEN 'acceptable'
         ELSE 'good' END AS performance,
    CASE WHEN contains(lower(query), 'select') THEN 'read'
         WHEN regexp_matches(lower(query), 'insert|update|delete') THEN 'write' END AS query_type,
    printf('Query executed %d times with avg latency %.2fms.', calls, mean_time_ms) AS message
  FROM qr WHERE ok
)"""

ORACLE: dict[str, str] = {}

ORACLE["normalize_queries"] = f"""
WITH {BASE}, {QROWS}
SELECT env_ts AS timestamp, host AS entity_id, 'database_query' AS event_type,
  'postgresql' AS source, environment, message, query_hash, performance, query_type, calls,
  round(mean_time_ms, 4) AS mean_time_ms, trace_id, database
FROM q
"""

METRIC_NAME = _case("event_type", td.METRIC_NAMES)
METRIC_UNIT = _case("event_type", td.METRIC_UNITS)
RES_ENV = "CASE user_id % 3 WHEN 0 THEN 'production' WHEN 1 THEN 'staging' ELSE 'development' END"
SYSLOG_APP = ("CASE event_id % 4 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(td.SYSLOG_TAGS))
              + " END")

# Custom log events (FP3 + FP4 + FP8).
LROWS = """
l AS (
  SELECT b.*,
    CASE event_type WHEN 'error' THEN CASE WHEN event_id % 4 = 0 THEN 'critical' ELSE 'error' END
      WHEN 'signup' THEN 'warning' ELSE 'info' END AS log_level,
    CASE event_type
      WHEN 'error' THEN 'Query error E' || CAST(event_id % 50 AS VARCHAR) || ': ' ||
        CASE WHEN event_id % 2 = 0 THEN 'relation r' || CAST(user_id AS VARCHAR) || ' missing' ELSE 'Unknown' END
      WHEN 'signup' THEN 'Detected ' || CAST(event_id % 5 AS VARCHAR) || ' deadlock(s).'
      WHEN 'purchase' THEN CAST(event_id % 10 AS VARCHAR) || '/20 active connections.'
      WHEN 'click' THEN 'Log event of type ''checkpoint'' received.'
      ELSE 'Log event of type ''unknown event'' received.' END AS message,
    CASE event_type WHEN 'error' THEN 'query_error' WHEN 'signup' THEN 'deadlocks'
      WHEN 'purchase' THEN 'connection_stats' WHEN 'click' THEN 'checkpoint' END AS payload_event_type
  FROM b WHERE ok
)"""

# Metric rows (FP7 + FP10).
MROWS = f"""
m AS (
  SELECT b.*, {METRIC_NAME} AS metric_name, {METRIC_UNIT} AS unit,
    CASE WHEN event_type IN ('view', 'click') THEN CAST(floor(value) AS DOUBLE) ELSE value END AS metric_value,
    CASE WHEN event_type IN ('view', 'click') THEN 'gauge' ELSE 'counter' END AS metric_type,
    CASE WHEN user_id % 10 = 9 THEN 'unknown_host' ELSE host END AS entity_id,
    {RES_ENV} AS res_env
  FROM b
)"""

# OTLP log records (FP5).
HROWS = f"""
h AS (
  SELECT b.*,
    CASE WHEN user_id % 10 = 9 THEN 'unknown_syslog_host' ELSE host END AS entity_id,
    {RES_ENV} AS res_env,
    CASE WHEN event_type = 'view' THEN 'No message body'
      ELSE concat_ws(' ', event_type, 'from user', CAST(user_id AS VARCHAR), props) END AS h_message,
    CASE WHEN event_type = 'error' THEN 'err' ELSE 'info' END AS severity,
    CASE WHEN event_type = 'click' THEN trace_id END AS h_trace
  FROM b
)"""

# Every silver event of the pipeline (UN1).
EVROWS = """
ev AS (
  SELECT env_ts AS timestamp, host AS entity_id, 'database_query' AS event_type, 'postgresql' AS source,
         environment, message, trace_id FROM q
  UNION ALL
  SELECT env_ts, host, 'log', 'postgresql', environment, message, trace_id FROM l
  UNION ALL
  SELECT ts, entity_id, 'syslog', 'syslog', res_env, h_message, h_trace FROM h
)"""

ALL = f"WITH {BASE}, {QROWS}, {LROWS}, {MROWS}, {HROWS}, {EVROWS}"

ORACLE["normalize_logs"] = f"""
{ALL}
SELECT env_ts AS timestamp, host AS entity_id, 'log' AS event_type, 'postgresql' AS source, environment,
  message, log_level,
  CASE WHEN log_level IN ('error', 'critical', 'alert', 'emergency') THEN 'true' END AS requires_alert,
  CASE WHEN contains(coalesce(payload_event_type, ''), 'deadlock') THEN 'database_concurrency' END AS category,
  trace_id, database
FROM l
"""

ORACLE["flatten_metrics"] = f"""
{ALL}
SELECT ts AS timestamp, entity_id, metric_name, round(metric_value, 4) AS metric_value, metric_type,
  'postgresql' AS source, res_env AS environment, unit,
  CASE WHEN contains(metric_name, 'error') AND metric_value > 0 THEN 'warning' END AS severity,
  database AS database_tag, 'Synthetic ' || metric_name AS description
FROM m
"""

ORACLE["normalize_otlp_logs"] = f"""
{ALL}
SELECT ts AS timestamp, entity_id, 'syslog' AS event_type, 'syslog' AS source, res_env AS environment,
  h_message AS message, severity, '' AS app, h_trace AS trace_id
FROM h
"""

ORACLE["syslog_events"] = f"""
{ALL}
SELECT date_trunc('second', ts) AS timestamp, host AS entity_id, 'syslog' AS event_type,
  'development' AS environment, event_type || ' ' || props AS message,
  CAST((event_id % 192) // 8 AS INTEGER) AS facility, CAST(event_id % 8 AS INTEGER) AS severity,
  {SYSLOG_APP} AS appname,
  CASE WHEN event_id % 4 = 2 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS proc_id,
  'otel-collector' AS service_name
FROM b
"""

# Message-level view of the four topics (route, reason).
MSGS = f"""
msgs AS (
  SELECT CASE WHEN event_id % {td.NO_TOPIC_MOD} = 0 AND not_json THEN 'ignored' ELSE k.route END AS route,
    CASE WHEN event_id % {td.NO_TOPIC_MOD} = 0 THEN '' ELSE k.topic END AS topic,
    CASE WHEN not_json THEN 'not_json' WHEN null_payload THEN 'null_field:payload' END AS reason
  FROM b, (VALUES ('queries', 'raw-queries'), ('logs', 'raw-logs')) k(route, topic)
  UNION ALL
  SELECT 'metrics', 'otel-metrics', NULL FROM (SELECT DISTINCT user_id, event_id // {td.CHUNK} FROM b)
  UNION ALL
  SELECT 'host_logs', 'raw-host-logs', NULL FROM (SELECT DISTINCT user_id, event_id // {td.CHUNK} FROM b)
)"""

ORACLE["route"] = f"""
WITH {BASE}, {MSGS}
SELECT route, count(*) AS messages, count(*) FILTER (WHERE reason IS NULL) AS accepted,
  count(*) FILTER (WHERE reason IS NOT NULL) AS rejected
FROM msgs GROUP BY route
"""

ORACLE["dead_letter"] = f"""
WITH {BASE}, {MSGS}
SELECT topic, route, reason, count(*) AS messages FROM msgs WHERE reason IS NOT NULL GROUP BY ALL
"""

ORACLE["unified_events"] = f"""
{ALL}
SELECT event_type, entity_id, environment, count(*) AS events, min(timestamp) AS first_ts,
  max(timestamp) AS last_ts
FROM ev GROUP BY ALL
"""

ENT_CTES = """
rec AS (
  SELECT entity_id, timestamp, source, environment FROM ev
  UNION ALL SELECT entity_id, ts, 'postgresql', res_env FROM m
),
agg AS (
  SELECT entity_id, min(timestamp) AS first_seen, max(timestamp) AS last_seen, count(*) AS records,
    max(CASE WHEN source IN ('postgresql', 'mysql', 'mongodb', 'oracle', 'sqlserver', 'redis')
        THEN 1 ELSE 0 END) AS db
  FROM rec GROUP BY entity_id
),
latest AS (
  SELECT entity_id, source, environment,
    row_number() OVER (PARTITION BY entity_id ORDER BY timestamp DESC, source DESC, environment DESC) AS rn
  FROM rec
)"""

ENTITIES = f"""
{ALL}, {ENT_CTES}
SELECT a.entity_id, CASE WHEN db = 1 THEN 'database_host' ELSE 'host' END AS entity_type,
  first_seen, last_seen, l.source, l.environment, records
FROM agg a JOIN latest l ON a.entity_id = l.entity_id AND l.rn = 1
"""
ORACLE["derive_entities"] = ENTITIES
# merging two halves must give the same entities as deriving them at once
ORACLE["upsert_entities"] = ENTITIES

ORACLE["fingerprint_rollup"] = f"""
{ALL}
SELECT query_hash, count(*) AS samples, CAST(sum(calls) AS BIGINT) AS total_calls,
  round(sum(calls * mean_time_ms), 2) AS total_time_ms, round(max(mean_time_ms), 4) AS max_mean_time_ms,
  arg_min(query, env_ts) AS sample_query,
  round(sum(calls * mean_time_ms) / sum(calls), 4) AS weighted_mean_ms
FROM q WHERE query_hash IS NOT NULL GROUP BY query_hash
"""

ORACLE["derived_ratios"] = f"""
{ALL},
d AS (
  SELECT entity_id, date_trunc('day', ts) AS bucket,
    sum(CASE WHEN metric_name = 'postgresql.blocks_hit' THEN metric_value END) AS hit,
    sum(CASE WHEN metric_name = 'postgresql.blocks_read' THEN metric_value END) AS rd,
    sum(CASE WHEN metric_name = 'postgresql.commits' THEN metric_value END) AS cm,
    sum(CASE WHEN metric_name = 'postgresql.rollbacks' THEN metric_value END) AS rb
  FROM m GROUP BY ALL
),
hours AS (
  SELECT host, date_trunc('hour', ts) AS hour, count(*) AS backends, count(DISTINCT database) AS dbs FROM b GROUP BY ALL
),
s AS (
  SELECT host AS entity_id, date_trunc('day', hour) AS bucket, max(backends) AS backends, max(dbs) AS dbs
  FROM hours GROUP BY ALL
)
SELECT coalesce(d.entity_id, s.entity_id) AS entity_id, coalesce(d.bucket, s.bucket) AS bucket,
  round(hit, 4) AS blocks_hit, round(rd, 4) AS blocks_read,
  round(cm, 4) AS commits, round(rb, 4) AS rollbacks,
  round(CASE WHEN hit + rd <> 0 THEN hit / (hit + rd) END, 6) AS cache_hit_ratio,
  round(CASE WHEN cm + rb <> 0 THEN cm / (cm + rb) END, 6) AS commit_ratio,
  round(CAST(s.backends AS DOUBLE) / s.dbs, 6) AS backends_per_db
FROM d FULL OUTER JOIN s ON d.entity_id = s.entity_id AND d.bucket = s.bucket
"""

ORACLE["rollup"] = f"""
{ALL}
SELECT date_trunc('hour', ts) AS window_start, entity_id, metric_name, count(*) AS samples,
  round(min(metric_value), 4) AS min_value, round(max(metric_value), 4) AS max_value,
  round(avg(metric_value), 6) AS avg_value, round(sum(metric_value), 4) AS sum_value
FROM m GROUP BY ALL
"""

ORACLE["regression"] = f"""
{ALL},
qb AS (
  SELECT host AS entity_id, query_hash, date_trunc('day', env_ts) AS bucket, count(*) AS samples,
    sum(mean_time_ms) AS sum_mean
  FROM q WHERE query_hash IS NOT NULL GROUP BY ALL
),
w AS (
  SELECT *,
    sum(sum_mean) OVER (PARTITION BY entity_id, query_hash ORDER BY bucket
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hist_sum,
    sum(samples) OVER (PARTITION BY entity_id, query_hash ORDER BY bucket
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hist_n
  FROM qb
)
SELECT entity_id, query_hash, bucket, samples, round(sum_mean / samples, 6) AS current_mean,
  round(hist_sum / hist_n, 6) AS historical_mean,
  round((sum_mean / samples) / (hist_sum / hist_n), 6) AS ratio
FROM w WHERE sum_mean / samples > (hist_sum / hist_n) * 1.5
"""

QID = f"'q' || CAST(event_id % {len(td.QUERY_TEXTS)} AS VARCHAR)"

ORACLE["topk_total_time"] = f"""
{ALL}
SELECT host, env_ts AS timestamp, {QID} AS query_id, substr(query, 1, 500) AS query_text, calls,
  round(calls * mean_time_ms, 4) AS total_time_ms, round(mean_time_ms, 4) AS mean_time_ms
FROM q WHERE coalesce(query, '') NOT LIKE '%pg_stat%'
ORDER BY calls * mean_time_ms DESC, host, env_ts, {QID} LIMIT 20
"""

ORACLE["topk_calls"] = f"""
{ALL}
SELECT host, env_ts AS timestamp, {QID} AS query_id, calls, round(mean_time_ms, 4) AS mean_time_ms
FROM q ORDER BY calls DESC, host, env_ts, {QID} LIMIT 10
"""

ORACLE["filter_entity_since"] = f"""
{ALL}
SELECT timestamp, entity_id, event_type, message FROM ev
WHERE entity_id = 'host-3' AND timestamp > TIMESTAMP '2024-01-15'
"""

ORACLE["filter_source_type"] = f"""
{ALL}
SELECT entity_id, environment, count(*) AS events FROM ev
WHERE source = 'postgresql' AND event_type = 'database_query' GROUP BY ALL
"""

ORACLE["filter_metric_entity"] = f"""
{ALL}
SELECT ts AS timestamp, round(metric_value, 4) AS metric_value, res_env AS environment FROM m
WHERE metric_name = 'postgresql.commits' AND entity_id = 'host-2'
"""

ORACLE["filter_time_between"] = f"""
{ALL}
SELECT timestamp, entity_id, event_type, message FROM ev
WHERE timestamp BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-11 00:00:00'
"""

ORACLE["filter_slow_1000"] = f"""
{ALL}
SELECT host, env_ts AS timestamp, {QID} AS query_id, round(mean_time_ms, 4) AS mean_time_ms
FROM q WHERE mean_time_ms > 1000
"""

ORACLE["filter_logs_combined"] = f"""
{ALL}
SELECT env_ts AS timestamp, host, database AS database_name, log_level, message FROM l
WHERE env_ts > TIMESTAMP '2024-01-20' AND host = 'host-1' AND log_level = 'error'
"""

ORACLE["filter_offset_range"] = f"""
{ALL}
SELECT env_ts AS timestamp, host AS entity_id, message FROM q WHERE event_id > 1000 AND event_id < 2000
"""

ORACLE["filter_slow_queries"] = f"""
{ALL}
SELECT host, env_ts AS timestamp, {QID} AS query_id, round(mean_time_ms, 4) AS mean_time_ms
FROM q WHERE mean_time_ms > 100
"""

ORACLE["filter_poor_cache"] = f"""
{ALL}
SELECT host, env_ts AS timestamp, {QID} AS query_id, round(cache_hit_ratio, 4) AS cache_hit_ratio
FROM q WHERE cache_hit_ratio < 0.8
"""

ORACLE["filter_high_volume"] = f"""
{ALL}
SELECT host, env_ts AS timestamp, {QID} AS query_id, calls FROM q WHERE calls > 10000
"""

ORACLE["filter_errors_deadlocks"] = f"""
{ALL}
SELECT env_ts AS timestamp, host AS entity_id, log_level, message FROM l
WHERE log_level = 'error' OR payload_event_type = 'deadlocks'
"""

ORACLE["statement_shaping"] = f"""
{ALL}
SELECT host, env_ts AS timestamp, {QID} AS query_id, substr(query, 1, 500) AS query_text,
  round(calls * mean_time_ms, 4) AS total_time_ms, round(mean_time_ms, 4) AS mean_time_ms
FROM q WHERE coalesce(query, '') NOT LIKE '%pg_stat%'
"""

ALERTS = """
al AS (
  SELECT env_ts AS ts, host AS entity_id, database, 'requires_alert' AS rule FROM l
    WHERE log_level IN ('error', 'critical', 'alert', 'emergency')
  UNION ALL SELECT env_ts, host, database, 'database_concurrency' FROM l
    WHERE contains(coalesce(payload_event_type, ''), 'deadlock')
  UNION ALL SELECT env_ts, host, database, 'slow_query' FROM q WHERE mean_time_ms > 1000
  UNION ALL SELECT ts, entity_id, database, 'metric_warning' FROM m WHERE contains(metric_name, 'error') AND metric_value > 0
)"""

ORACLE["join_customer_orders"] = """
SELECT c_name, count(o_orderkey) AS order_count
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_name
"""

ORACLE["join_full_outer"] = """
SELECT c_custkey, c_name, o_orderkey, o_custkey, round(o_totalprice, 2) AS o_totalprice
FROM customer FULL OUTER JOIN orders ON c_custkey = o_custkey
"""

ORACLE["entity_lookup"] = f"""
{ALL}, {ENT_CTES}
SELECT e.event_type, CASE WHEN a.db = 1 THEN 'database_host' ELSE 'host' END AS entity_type,
  count(*) AS events
FROM ev e LEFT JOIN agg a ON e.entity_id = a.entity_id GROUP BY ALL
"""

ORACLE["trace_correlation"] = f"""
{ALL}
SELECT trace_id, count(*) AS events, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
  array_to_string(list_sort(list_distinct(list(entity_id))), ',') AS entities,
  array_to_string(list_sort(list_distinct(list(event_type))), ',') AS event_types
FROM ev WHERE trace_id IS NOT NULL GROUP BY trace_id
"""

ACT = """
act AS (
  SELECT host, database, date_trunc('hour', ts) AS snapshot_ts,
    CASE event_type WHEN 'purchase' THEN 'active' WHEN 'view' THEN 'idle'
      WHEN 'click' THEN 'idle in transaction' END AS state,
    event_type = 'error' AS deadlock
  FROM b
),
snaps AS (
  SELECT host, database, snapshot_ts, count(*) AS total,
    count(*) FILTER (WHERE state = 'active') AS active, count(*) FILTER (WHERE state = 'idle') AS idle,
    count(*) FILTER (WHERE deadlock) AS deadlocks
  FROM act GROUP BY ALL
)"""

ORACLE["filtered_counts"] = f"""
WITH {BASE}, {ACT}
SELECT host, database, snapshot_ts, total, active, idle FROM snaps
"""

ORACLE["stats_envelopes"] = f"""
WITH {BASE}, {ACT}
SELECT host || ':' || database AS key, host, database, snapshot_ts AS timestamp, 'info' AS log_level,
  'connection_stats' AS event_type, CAST(NULL AS DOUBLE) AS count, CAST(total AS DOUBLE) AS total,
  CAST(active AS DOUBLE) AS active, CAST(idle AS DOUBLE) AS idle
FROM snaps
UNION ALL
SELECT host || ':' || database, host, database, snapshot_ts, 'warning', 'deadlocks', CAST(deadlocks AS DOUBLE),
  NULL, NULL, NULL
FROM snaps WHERE deadlocks > 0
"""

EMSG = f"""
em AS (
  SELECT CASE WHEN event_id % {td.NO_TOPIC_MOD} = 0 THEN '' ELSE k.topic END AS topic, not_json, ingest_ts
  FROM b, (VALUES ('raw-queries'), ('raw-logs')) k(topic)
),
g AS (SELECT max(ingest_ts) AS ingest_ts FROM b GROUP BY user_id, event_id // {td.CHUNK})"""

ORACLE["envelope_completeness"] = f"""
WITH {BASE}, {EMSG}
SELECT topic, count(*) AS messages, count(*) FILTER (WHERE not_json) AS bad_json,
  CAST(0 AS BIGINT) AS missing_timestamp, CAST(0 AS BIGINT) AS missing_source,
  CAST(0 AS BIGINT) AS missing_data_type, CAST(0 AS BIGINT) AS missing_host,
  CAST(0 AS BIGINT) AS missing_database
FROM em GROUP BY topic
UNION ALL
SELECT t.topic, count(*), 0, count(*), count(*), count(*), count(*), count(*)
FROM g, (VALUES ('otel-metrics'), ('raw-host-logs')) t(topic) GROUP BY t.topic
"""

ORACLE["alert_rollup"] = f"""
{ALL}, {ALERTS}
SELECT date_trunc('day', ts) AS window_start, entity_id, rule, count(*) AS alerts FROM al GROUP BY ALL
"""

ORACLE["row_count"] = f"""
{ALL}
SELECT 'events' AS table_name, count(*) AS row_count FROM ev
UNION ALL SELECT 'metrics', count(*) FROM m
"""

ORACLE["dedup_by_id"] = f"""
{ALL}
SELECT env_ts AS timestamp, host AS entity_id, message, trace_id FROM q
"""

ORACLE["scan_limit"] = f"""
{ALL}
SELECT timestamp, entity_id, event_type, message FROM ev
ORDER BY timestamp, entity_id, event_type, message LIMIT 5
"""

ORACLE["syslog_scan_limit"] = f"""
{ALL}
SELECT timestamp, entity_id, event_type, message FROM ev WHERE event_type = 'syslog'
ORDER BY timestamp, entity_id, message LIMIT 5
"""

ORACLE["db_queries_view"] = f"""
{ALL}
SELECT env_ts AS timestamp, host, database AS database_name, round(mean_time_ms, 4) AS mean_time_ms,
  'postgresql' AS source, environment, {QID} AS query_id, query AS query_text, query_hash, calls,
  round(calls * mean_time_ms, 4) AS total_time_ms, round(cache_hit_ratio, 4) AS cache_hit_ratio
FROM q
"""

ORACLE["db_logs_view"] = f"""
{ALL}
SELECT env_ts AS timestamp, host, database AS database_name, log_level, 'postgresql' AS source, environment,
  coalesce(payload_event_type, 'log') AS event_type, message
FROM l
"""

ORACLE["db_metrics_view"] = f"""
{ALL}
SELECT ts AS timestamp, entity_id AS host, database AS database_name, metric_name, 'postgresql' AS source,
  res_env AS environment, round(metric_value, 4) AS metric_value, metric_type, unit
FROM m
"""

_KEEP = " OR ".join(f"(topic = '{t}' AND ingest_ts >= TIMESTAMP '2024-01-30' - INTERVAL {d} DAY)"
                    for t, d in {"otel-metrics": 7, "raw-logs": 30, "raw-queries": 90,
                                 "raw-host-logs": 7}.items()) + (
    " OR topic IS NULL OR topic NOT IN ('otel-metrics', 'raw-logs', 'raw-queries', 'raw-host-logs')")
ORACLE["retention"] = f"""
WITH {BASE}, {EMSG},
allm AS (
  SELECT topic, ingest_ts FROM em
  UNION ALL SELECT 'otel-metrics', ingest_ts FROM g
  UNION ALL SELECT 'raw-host-logs', ingest_ts FROM g
)
SELECT topic, count(*) AS messages FROM allm WHERE {_KEEP} GROUP BY topic
"""

ORACLE["insert_if_absent"] = f"""
{ALL}
SELECT host AS entity_id, env_ts AS timestamp, message FROM q
WHERE env_ts >= TIMESTAMP '2024-01-20'
"""

ORACLE["processed_topics"] = f"""
{ALL}, {ALERTS}
SELECT topic, count(*) AS messages FROM (
  SELECT CASE WHEN event_type = 'database_query' THEN 'processed-queries' ELSE 'processed-logs' END AS topic
  FROM ev
  UNION ALL SELECT 'processed-metrics' FROM m
  UNION ALL SELECT 'alerts' FROM al
) GROUP BY topic
"""

ORACLE["validation_report"] = f"""
{ALL}
SELECT 'events' AS table_name, CAST(NULL AS VARCHAR) AS violation, count(*) AS row_count FROM ev
UNION ALL SELECT 'metrics', NULL, count(*) FROM m
UNION ALL SELECT 'metrics', 'bad:metric_value', count(*) FROM m WHERE event_type = 'error'
"""

ORACLE["stream_normalize"] = f"""
{ALL}
SELECT event_type, entity_id, count(*) AS events, count(*) AS ids, min(timestamp) AS first_ts,
  CAST(sum(length(message)) AS BIGINT) AS message_chars
FROM ev GROUP BY ALL
"""

# append mode emits a window once the watermark (max event time - 10 min) has passed its end
ORACLE["stream_window_rollup"] = f"""
{ALL}
SELECT date_trunc('hour', ts) AS window_start, entity_id, metric_name, count(*) AS samples,
  round(min(metric_value), 4) AS min_value, round(max(metric_value), 4) AS max_value,
  round(sum(metric_value), 4) AS sum_value
FROM m
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM m) - INTERVAL 10 MINUTE
GROUP BY ALL
"""

ORACLE["stream_dedup"] = ORACLE["dedup_by_id"]

ORACLE["slow_query_stream"] = f"""
{ALL}
SELECT 'slow-queries' AS topic, host || ':' || database AS key, count(*) AS messages,
  round(max(mean_time_ms), 4) AS slowest_ms, max(epoch_us(env_ts)) AS last_us
FROM q WHERE mean_time_ms > 100 GROUP BY ALL
"""

ORACLE["alert_stream"] = f"""
{ALL}, {ALERTS}
SELECT 'alerts' AS topic, entity_id || ':' || database AS key, rule, count(*) AS messages FROM al GROUP BY ALL
"""

ORACLE["table_roundtrip"] = f"""
{ALL}
SELECT CAST(CAST(timestamp AS DATE) AS VARCHAR) AS event_date, event_type, count(*) AS rows_read,
  CAST(sum(length(message)) AS BIGINT) AS chars, round(sum(CASE WHEN event_type = 'database_query' THEN amount END), 2) AS amount
FROM (SELECT timestamp, event_type, message, NULL AS amount FROM ev WHERE event_type <> 'database_query'
      UNION ALL SELECT env_ts, 'database_query', message, mean_time_ms FROM q)
WHERE timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 23:59:59'
GROUP BY ALL
UNION ALL
SELECT CAST(CAST(ts AS DATE) AS VARCHAR), 'metric', count(*), CAST(sum(length(unit)) AS BIGINT), round(sum(metric_value), 2) FROM m
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY ALL
"""

ORACLE["entities_table"] = ORACLE["derive_entities"]

# decoding the protobuf form must give the same rows as the JSON form
ORACLE["protobuf_metrics"] = ORACLE["flatten_metrics"]

# the text copy of orders must join exactly like the Parquet one
ORACLE["join_text_table"] = ORACLE["join_full_outer"]

# the collector's upsert sets deployment.environment on every resource
ORACLE["collector_resource_metrics"] = f"""
{ALL}
SELECT ts AS timestamp, entity_id, metric_name, round(metric_value, 4) AS metric_value, metric_type,
  'postgresql' AS source, 'development' AS environment, unit,
  CASE WHEN contains(metric_name, 'error') AND metric_value > 0 THEN 'warning' END AS severity,
  database AS database_tag, 'Synthetic ' || metric_name AS description
FROM m
"""

ORACLE["topic_volume"] = f"""
WITH {BASE}, lines AS (
  SELECT ingest_ts, '<' || CAST(event_id % 192 AS VARCHAR) || '>' || strftime(ts, '%b %d %H:%M:%S') || ' ' || host || ' '
    || {SYSLOG_APP} || CASE WHEN event_id % 4 = 2 THEN '' ELSE '[' || CAST(user_id AS VARCHAR) || ']' END || ': '
    || event_type || ' ' || props AS value
  FROM b
)
SELECT 'syslog' AS topic, date_trunc('hour', ingest_ts) AS window_start, count(*) AS messages,
  CAST(sum(strlen(value)) AS BIGINT) AS total_bytes, round(avg(strlen(value)), 4) AS mean_bytes
FROM lines GROUP BY ALL
"""

ORACLE["limit_any"] = f"""
{ALL}
SELECT t.table_name, least(5, (SELECT count(*) FROM ev)) AS row_count
FROM (VALUES ('returned'), ('held')) t(table_name)
"""

# rows without a readable envelope never reach the stream's state
ORACLE["stream_late_rows"] = f"""
WITH {BASE}
SELECT count(*) FILTER (WHERE ingest_ts >= TIMESTAMP '2024-01-15') AS kept,
  count(*) FILTER (WHERE ingest_ts < TIMESTAMP '2024-01-15') AS late,
  count(*) FILTER (WHERE ingest_ts >= TIMESTAMP '2024-01-15') AS doubles
FROM b WHERE ok
"""

ORACLE["document_metrics"] = ORACLE["flatten_metrics"]

ORACLE["table_lifecycle"] = f"""
{ALL}
SELECT 'events' AS table_name, count(*) AS row_count FROM ev
UNION ALL SELECT 'metrics', count(*) FROM m
UNION ALL SELECT 'entities', count(DISTINCT entity_id)
  FROM (SELECT entity_id FROM ev UNION ALL SELECT entity_id FROM m)
UNION ALL SELECT 'notes', 0
"""

ORACLE["retention_table"] = f"""
WITH {BASE}, {EMSG},
allm AS (
  SELECT CASE WHEN topic = '' THEN '-' ELSE topic END AS topic, ingest_ts FROM em
  UNION ALL SELECT 'otel-metrics', ingest_ts FROM g
  UNION ALL SELECT 'raw-host-logs', ingest_ts FROM g
),
kept AS (
  SELECT a.topic, a.ingest_ts, TIMESTAMP '2024-01-30 12:00:00' - to_days(CAST(r.days AS INTEGER)) AS cut
  FROM allm a LEFT JOIN (VALUES ('otel-metrics', 7), ('raw-logs', 30), ('raw-queries', 90), ('raw-host-logs', 7))
    r(topic, days) ON a.topic = r.topic
)
SELECT topic, count(*) FILTER (WHERE cut IS NULL OR ingest_ts >= cut) AS messages,
  count(DISTINCT CASE WHEN CAST(ingest_ts AS DATE) < CAST(cut AS DATE) THEN CAST(ingest_ts AS DATE) END) AS dropped_days
FROM kept GROUP BY topic HAVING count(*) FILTER (WHERE cut IS NULL OR ingest_ts >= cut) > 0
"""
