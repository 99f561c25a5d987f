"""Analytical operators over the silver ``events`` / ``metrics`` tables.

Scale notes (what keeps these plans flat at 100 TB):

* every aggregation uses functions with a partial (map-side) phase — count,
  sum, min, max, min_by/max_by, count_if — so a hot key (``unknown_host``
  holding a third of all rows) is pre-reduced in each task before the shuffle;
* window functions only run over already-aggregated buckets (AG7), never over
  raw rows of one key;
* top-k uses ``orderBy().limit()`` → ``TakeOrderedAndProject`` (per-task heaps
  of k rows, no global sort);
* dedup keeps the first copy with ``min_by`` inside a ``groupBy`` (partial
  aggregation), not ``row_number`` over a window partition, so a group of
  copies never has to fit in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.sinks.tables import typed_events, typed_metrics

# Thresholds and retention documented for the topics.
SLOW_QUERY_MS = 100.0
POOR_CACHE_RATIO = 0.8
HIGH_VOLUME_CALLS = 10000
REGRESSION_FACTOR = 1.5
STATEMENT_CHARS = 500
RETENTION_DAYS = {"otel-metrics": 7, "raw-logs": 30, "raw-queries": 90, "raw-host-logs": 7}
ERROR_LEVELS = ["error"]


# --- filters (FP13-FP20) ------------------------------------------------------

def events_for_entity_since(events: DataFrame, entity_id: str, since: str) -> DataFrame:
    """FP13: one entity after a point in time."""
    return events.where((F.col("entity_id") == entity_id) & (F.col("timestamp") > F.lit(since).cast("timestamp")))


def events_by_source_type(events: DataFrame, source: str, event_type: str) -> DataFrame:
    """FP14."""
    return events.where((F.col("source") == source) & (F.col("event_type") == event_type))


def metric_for_entity(metrics: DataFrame, metric_name: str, entity_id: str) -> DataFrame:
    """FP15."""
    return metrics.where((F.col("metric_name") == metric_name) & (F.col("entity_id") == entity_id))


def time_range(df: DataFrame, start: str, end: str, column: str = "timestamp") -> DataFrame:
    """FP16: inclusive ``BETWEEN`` on a timestamp column."""
    return df.where(F.col(column).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def id_range(df: DataFrame, low: int, high: int, column: str = "offset") -> DataFrame:
    """FP18: exclusive range on an explicit id column."""
    return df.where((F.col(column) > low) & (F.col(column) < high))


def slow_queries(db_queries: DataFrame, threshold_ms: float = SLOW_QUERY_MS) -> DataFrame:
    """FP17 / FP19: ``mean_time_ms`` above a threshold."""
    return db_queries.where(F.col("mean_time_ms") > threshold_ms)


def poor_cache(db_queries: DataFrame, ratio: float = POOR_CACHE_RATIO) -> DataFrame:
    """FP19: cache hit ratio below a bound."""
    return db_queries.where(F.col("cache_hit_ratio") < ratio)


def high_volume(db_queries: DataFrame, calls: int = HIGH_VOLUME_CALLS) -> DataFrame:
    """FP19: statements called more than ``calls`` times."""
    return db_queries.where(F.col("calls") > calls)


def logs_combined(db_logs: DataFrame, since: str, host: str, level: str) -> DataFrame:
    """FP17: time + host + level."""
    return db_logs.where((F.col("timestamp") > F.lit(since).cast("timestamp"))
                         & (F.col("host") == host) & (F.col("log_level") == level))


def errors_and_deadlocks(events: DataFrame) -> DataFrame:
    """FP20: error-level log events and deadlock reports."""
    return typed_events(events).where((F.col("event_type") == "log")
                                      & (F.col("log_level").isin(*ERROR_LEVELS) | (F.col("payload_type") == "deadlocks")))


def shape_statements(db_queries: DataFrame) -> DataFrame:
    """FP21: drop monitoring statements, id → text, text → first 500 chars, times → double."""
    return (db_queries.where(~F.coalesce(F.col("query_text"), F.lit("")).like("%pg_stat%"))
            .withColumn("query_id", F.col("query_id").cast("string"))
            .withColumn("query_text", F.substring("query_text", 1, STATEMENT_CHARS))
            .withColumn("total_time_ms", F.col("total_time_ms").cast("double"))
            .withColumn("mean_time_ms", F.col("mean_time_ms").cast("double")))


# --- top-k (TK1, TK2, TK3) ----------------------------------------------------

def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """Ordered limit; give a total order (tie-break keys) for a stable answer."""
    return df.orderBy(*order).limit(k)


def top_statements_by_total_time(db_queries: DataFrame, k: int = 20) -> DataFrame:
    """TK1: statement shaping, then the k most expensive by total time."""
    return top_k(shape_statements(db_queries), k,
                 [F.col("total_time_ms").desc(), F.col("host"), F.col("timestamp"), F.col("query_id")])


def top_statements_by_calls(db_queries: DataFrame, k: int = 10) -> DataFrame:
    """TK2."""
    return top_k(db_queries, k, [F.col("calls").desc(), F.col("host"), F.col("timestamp"),
                                 F.col("query_id")])


# --- aggregations -------------------------------------------------------------

def filtered_counts(df: DataFrame, state: Column, keys: list[str], **extra: Column) -> DataFrame:
    """AG1: total and per-state counts in one pass (``extra``: more named aggregates
    over the same groups, so no second aggregation and join is needed)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"),
                                 F.count_if(state == "active").alias("active"),
                                 F.count_if(state == "idle").alias("idle"),
                                 *[c.alias(n) for n, c in extra.items()])


def fingerprint_rollup(query_events: DataFrame) -> DataFrame:
    """AG4: totals per query fingerprint.

    First a hash aggregate per (fingerprint, text) — few distinct texts share a
    fingerprint — then the sort-based ``min_by`` for the sample text runs on
    those reduced rows only.
    """
    per_text = (typed_events(query_events).where(F.col("query_hash").isNotNull())
                .groupBy("query_hash", F.col("query_text").alias("query"))
                .agg(F.count(F.lit(1)).alias("samples"),
                     F.sum("calls").alias("total_calls"),
                     F.sum("total_time_ms").alias("total_time_ms"),
                     F.max("mean_time_ms").alias("max_mean_time_ms"),
                     F.min("timestamp").alias("first_ts")))
    return (per_text.groupBy("query_hash")
            .agg(F.sum("samples").alias("samples"),
                 F.sum("total_calls").alias("total_calls"),
                 F.sum("total_time_ms").alias("total_time_ms"),
                 F.max("max_mean_time_ms").alias("max_mean_time_ms"),
                 F.min_by("query", "first_ts").alias("sample_query"))
            .withColumn("weighted_mean_ms", F.try_divide(F.col("total_time_ms"), F.col("total_calls"))))


def derived_ratios(metrics: DataFrame, bucket: str = "1 day") -> DataFrame:
    """AG5: cache hit, commit ratio and backends per database per entity and bucket.

    One pass with conditional sums (no pivot), ``try_divide`` for zero denominators.
    """
    name, v = F.col("metric_name"), F.col("metric_value")

    def s(metric):
        return F.sum(F.when(name == metric, v))

    out = (metrics.groupBy("entity_id", F.window("timestamp", bucket).start.alias("bucket"))
           .agg(s("postgresql.blocks_hit").alias("blocks_hit"),
                s("postgresql.blocks_read").alias("blocks_read"),
                s("postgresql.commits").alias("commits"),
                s("postgresql.rollbacks").alias("rollbacks"),
                F.max(F.when(name == "postgresql.backends", v)).alias("backends"),
                F.max(F.when(name == "postgresql.num_databases", v)).alias("num_databases")))
    return (out
            .withColumn("cache_hit_ratio",
                        F.try_divide(F.col("blocks_hit"), F.col("blocks_hit") + F.col("blocks_read")))
            .withColumn("commit_ratio",
                        F.try_divide(F.col("commits"), F.col("commits") + F.col("rollbacks")))
            .withColumn("backends_per_db", F.try_divide(F.col("backends"), F.col("num_databases"))))


def rollup(metrics: DataFrame, width: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """AG6: count/min/max/avg/sum per window, entity and metric."""
    w = F.window("timestamp", width, slide) if slide else F.window("timestamp", width)
    return (metrics.groupBy(w.alias("w"), "entity_id", "metric_name")
            .agg(F.count(F.lit(1)).alias("samples"), F.min("metric_value").alias("min_value"),
                 F.max("metric_value").alias("max_value"), F.avg("metric_value").alias("avg_value"),
                 F.sum("metric_value").alias("sum_value"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "entity_id", "metric_name", "samples", "min_value", "max_value", "avg_value",
                    "sum_value"))


def regression(query_events: DataFrame, bucket: str = "1 day",
               factor: float = REGRESSION_FACTOR) -> DataFrame:
    """AG7: buckets whose mean latency exceeds ``factor`` × the mean of all earlier buckets.

    Raw rows are first reduced to one row per (entity, fingerprint, bucket);
    the running window then sees one row per bucket, whatever the input size.
    """
    b = (typed_events(query_events).where(F.col("query_hash").isNotNull())
         .groupBy("entity_id", "query_hash", F.window("timestamp", bucket).start.alias("bucket"))
         .agg(F.count(F.lit(1)).alias("samples"), F.sum("mean_time_ms").alias("sum_mean")))
    prior = Window.partitionBy("entity_id", "query_hash").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    b = (b.withColumn("hist_sum", F.sum("sum_mean").over(prior))
          .withColumn("hist_n", F.sum("samples").over(prior))
          .withColumn("current_mean", F.col("sum_mean") / F.col("samples"))
          .withColumn("historical_mean", F.col("hist_sum") / F.col("hist_n")))
    return (b.where(F.col("current_mean") > F.col("historical_mean") * factor)
            .select("entity_id", "query_hash", "bucket", "samples", "current_mean", "historical_mean",
                    (F.col("current_mean") / F.col("historical_mean")).alias("ratio")))


def topic_volume(messages: DataFrame, width: str = "1 hour") -> DataFrame:
    """AG8: messages and bytes per topic and window."""
    return (messages.groupBy("topic", F.window("ingest_ts", width).start.alias("window_start"))
            .agg(F.count(F.lit(1)).alias("messages"),
                 F.sum(F.octet_length("value")).alias("total_bytes"),
                 F.avg(F.octet_length("value")).alias("mean_bytes")))


def alert_rows(events: DataFrame, metrics: DataFrame) -> DataFrame:
    """The alert stream (ST8/SK9 input): one row per triggered enrichment rule."""
    ev_rules = F.filter(F.array(
        F.when(F.col("requires_alert") == "true", F.lit("requires_alert")),
        F.when(F.col("category") == "database_concurrency", F.lit("database_concurrency")),
        F.when(F.col("performance") == "slow", F.lit("slow_query"))), lambda x: x.isNotNull())
    ev = typed_events(events).select("timestamp", "entity_id", "database", F.explode(ev_rules).alias("rule"))
    mt = typed_metrics(metrics).where(F.col("severity") == "warning").select(
        "timestamp", "entity_id", "database", F.lit("metric_warning").alias("rule"))
    return ev.unionByName(mt)


def alert_rollup(alerts: DataFrame, width: str = "1 day") -> DataFrame:
    """AG10: alerts per window, entity and rule."""
    return (alerts.groupBy(F.window("timestamp", width).start.alias("window_start"), "entity_id", "rule")
            .agg(F.count(F.lit(1)).alias("alerts")))


def first_deliveries(messages: DataFrame) -> DataFrame:
    """WN1 before the parse: one copy of each message (topic, partition, offset).

    Copies of a message are alike, so any of them stands for all.
    """
    at = ["topic", "partition", "offset"]
    rest = [c for c in messages.columns if c not in at]
    kept = messages.groupBy(*at).agg(F.min(F.struct(*rest)).alias("_r"))
    return kept.select(*at, "_r.*").select(*messages.columns)


def dedup_first(df: DataFrame, key: str = "id", order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """WN1: one row per key, the earliest by ``order`` and then by a hash of the whole row.

    ``min_by`` over a struct is a partial aggregate: each task keeps one row
    per key before the shuffle, so skewed groups of copies stay cheap.
    """
    cols = [c for c in df.columns if c != key]
    plain = [c for c in cols if not df.schema[c].dataType.simpleString().startswith(("map", "variant", "array", "struct"))]
    best = F.min_by(F.struct(*[F.col(c) for c in cols]),
                    F.struct(*[F.col(c) for c in order], F.xxhash64(*[F.col(c) for c in plain])))
    return df.groupBy(key).agg(best.alias("_r")).select(key, "_r.*")


def retention(df: DataFrame, as_of: str, days: dict[str, int] | None = None,
              topic_col: str = "topic", ts_col: str = "ingest_ts") -> DataFrame:
    """SK10: keep rows younger than the retention of their topic; topics without one keep all."""
    days = days or RETENTION_DAYS
    keep = F.col(topic_col).isNull() | ~F.col(topic_col).isin(*days)
    for topic, d in days.items():
        cond = (F.col(topic_col) == topic) & (
            F.col(ts_col) >= F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(d)} DAYS"))
        keep = keep | cond
    return df.where(keep)


def insert_if_absent(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """SK11: rows of ``new`` whose key is absent from ``existing`` (deduplicated)."""
    fresh = new.dropDuplicates(key)
    return fresh.join(existing.select(*key).distinct(), on=key, how="left_anti")


def trace_correlation(events: DataFrame) -> DataFrame:
    """JN4: events sharing a trace id, summarised per trace.

    Both sets have a partial phase and hold different values only, as the result itself does.
    """
    return (events.where(F.col("trace_id").isNotNull())
            .groupBy("trace_id")
            .agg(F.count(F.lit(1)).alias("events"), F.min("timestamp").alias("first_ts"),
                 F.max("timestamp").alias("last_ts"),
                 F.array_join(F.sort_array(F.collect_set("entity_id")), ",").alias("entities"),
                 F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("event_types")))


def table_counts(**tables: DataFrame) -> DataFrame:
    """AG11: ``count(*)`` of each named table, one row per table."""
    frames = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
