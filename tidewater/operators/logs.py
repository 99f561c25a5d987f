"""Log normalisation: custom log envelopes (FP3, FP4), OTLP log records (FP5),
syslog lines (SR6) and log enrichment (FP8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import (ALERT_LEVELS, DEFAULT_ENVIRONMENT, DEFAULT_LOG_LEVEL,
                                      DEFAULT_SOURCE, UNKNOWN_HOST, UNKNOWN_SYSLOG_HOST, add_tag,
                                      empty_str_map, empty_variant_map, iso_timestamp, kv_map,
                                      nanos_timestamp, py_str, row_id, vget)
from tidewater.operators.processor import EVENT_FIELDS, Processor

# Message templates by payload event type.
DEADLOCK_TEMPLATE = "Detected %s deadlock(s)."
CONNECTIONS_TEMPLATE = "%s/%s active connections."
QUERY_ERROR_TEMPLATE = "Query error %s: %s"
OTHER_TEMPLATE = "Log event of type '%s' received."
NO_BODY = "No message body"
CONCURRENCY_CATEGORY = "database_concurrency"


def log_message(payload):
    """FP4: human-readable summary chosen by ``payload.event_type``."""
    et = py_str(payload, "event_type", "unknown event")
    return (F.when(et == "deadlocks", F.format_string(DEADLOCK_TEMPLATE, py_str(payload, "count", "0")))
            .when(et == "connection_stats",
                  F.format_string(CONNECTIONS_TEMPLATE, py_str(payload, "active", "0"),
                                  py_str(payload, "total", "0")))
            .when(et == "query_error",
                  F.format_string(QUERY_ERROR_TEMPLATE, py_str(payload, "error_code", "N/A"),
                                  py_str(payload, "error_message", "Unknown")))
            .otherwise(F.format_string(OTHER_TEMPLATE, et)))


def normalize_logs(df: DataFrame) -> DataFrame:
    """FP3: processable custom log envelopes → ``log`` events."""
    env = F.col("env")
    df = (df.withColumn("payload", F.coalesce(F.col("payload"), empty_variant_map()))
            .withColumn("_time", vget(env["timestamp"])))
    payload = F.col("payload")
    tags = F.coalesce(F.try_variant_get(env["tags"], "$", "map<string,string>"), empty_str_map())
    return df.select(
        iso_timestamp(F.col("_time"), F.col("ingest_ts")).alias("timestamp"),
        F.coalesce(vget(env["host"]), F.lit(UNKNOWN_HOST)).alias("entity_id"),
        F.lit("log").alias("event_type"),
        F.coalesce(vget(env["source"]), F.lit(DEFAULT_SOURCE)).alias("source"),
        F.coalesce(vget(env["environment"]), F.lit(DEFAULT_ENVIRONMENT)).alias("environment"),
        log_message(payload).alias("message"),
        # the default level sits first so an explicit level overrides it
        F.map_concat(F.create_map(F.lit("log_level"), F.lit(DEFAULT_LOG_LEVEL)), tags).alias("tags"),
        payload.alias("attributes"),
        vget(payload["trace_id"]).alias("trace_id"),
        row_id(F.col("topic"), F.col("partition"), F.col("offset"), F.lit(0)).alias("id"),
        F.col("ingest_ts").alias("created_at"),
        vget(env["database"]).alias("database"),
        F.col("topic"),
    )


def enrich_logs(events: DataFrame) -> DataFrame:
    """FP8: alert flag for severe levels; concurrency category for deadlocks."""
    level = F.col("tags")["log_level"]
    et = F.coalesce(vget(F.col("attributes")["event_type"]), F.lit(""))
    tags = add_tag(F.col("tags"), level.isin(*ALERT_LEVELS), "requires_alert", "true")
    tags = add_tag(tags, et.contains("deadlock"), "category", CONCURRENCY_CATEGORY)
    return events.withColumn("tags", tags)


def otlp_log_records(df: DataFrame, first_only: bool = False) -> DataFrame:
    """Explode OTLP logs messages to one row per log record, beside the map of its resource's attributes.

    ``first_only`` keeps only element 0 at each level (the reference's reading).
    A message without any record is a dead letter, so a missing array yields none.
    """
    doc = F.col("host_logs_doc")

    def arr(c):
        return F.slice(c, 1, 1) if first_only else c

    return (df.select("topic", "partition", "offset", "ingest_ts", doc.alias("doc"))
            .select("*", F.posexplode(arr(F.col("doc.resourceLogs"))).alias("ri", "rl")).drop("doc")
            .withColumn("res", kv_map(F.col("rl.resource.attributes"), keep_empty=True))
            .select("*", F.posexplode(arr(F.col("rl.scopeLogs"))).alias("si", "sl")).drop("rl")
            .select("*", F.posexplode(arr(F.col("sl.logRecords"))).alias("li", "rec")).drop("sl"))


def normalize_otlp_logs(df: DataFrame, first_only: bool = False,
                        resource_upserts: dict[str, str] | None = None) -> DataFrame:
    """FP5: OTLP log records → ``syslog`` events (``resource_upserts``: FP12)."""
    recs = otlp_log_records(df, first_only)
    res = F.col("res")
    for k, v in (resource_upserts or {}).items():
        res = F.map_concat(res, F.create_map(F.lit(k), F.lit(v)))
    attrs = kv_map(F.col("rec.attributes"), keep_empty=True)
    return recs.select(
        nanos_timestamp(F.col("rec.timeUnixNano"), F.col("ingest_ts")).alias("timestamp"),
        F.coalesce(res["host.name"], F.lit(UNKNOWN_SYSLOG_HOST)).alias("entity_id"),
        F.lit("syslog").alias("event_type"),
        F.lit("syslog").alias("source"),
        F.coalesce(res["deployment.environment"], F.lit(DEFAULT_ENVIRONMENT)).alias("environment"),
        F.coalesce(F.col("rec.body.stringValue"), F.lit(NO_BODY)).alias("message"),
        attrs.alias("tags"),
        F.transform_values(attrs, lambda k, v: v.cast("variant")).alias("attributes"),
        F.col("rec.traceId").alias("trace_id"),
        row_id(F.col("topic"), F.col("partition"), F.col("offset"),
               F.concat_ws(".", F.coalesce("ri", F.lit(0)), F.coalesce("si", F.lit(0)),
                           F.coalesce("li", F.lit(0)))).alias("id"),
        F.col("ingest_ts").alias("created_at"),
        F.lit(None).cast("string").alias("database"),
        F.col("topic"),
    )


class LogsProcessor(Processor):
    route = "logs"

    def normalize(self, df: DataFrame) -> DataFrame:
        return normalize_logs(df).select(*EVENT_FIELDS)

    def enrich(self, df: DataFrame) -> DataFrame:
        return enrich_logs(df)


class HostLogsProcessor(Processor):
    route = "host_logs"

    def __init__(self, config=None, first_only: bool = False,
                 resource_upserts: dict[str, str] | None = None):
        super().__init__(config)
        self.first_only = first_only
        self.resource_upserts = resource_upserts

    def normalize(self, df: DataFrame) -> DataFrame:
        return normalize_otlp_logs(df, self.first_only, self.resource_upserts).select(*EVENT_FIELDS)

    def enrich(self, df: DataFrame) -> DataFrame:
        return enrich_logs(df)
