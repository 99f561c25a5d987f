"""FP6 query-statistics normalisation and FP9 query enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import (DEFAULT_ENVIRONMENT, DEFAULT_SOURCE, UNKNOWN_HOST, add_tag,
                                      empty_str_map, empty_variant_map, iso_timestamp, py_str,
                                      query_fingerprint, row_id, vget, vnumber)
from tidewater.operators.processor import EVENT_FIELDS, Processor

# Latency class thresholds (ms, strict >) and write keywords.
SLOW_MS = 1000
ACCEPTABLE_MS = 100
WRITE_PATTERN = "insert|update|delete"


def normalize_queries(df: DataFrame) -> DataFrame:
    """Processable ``queries`` messages → ``database_query`` events."""
    env = F.col("env")
    df = (df.withColumn("payload", F.coalesce(F.col("payload"), empty_variant_map()))
            .withColumn("_time", vget(env["timestamp"]))
            .withColumn("_query", vget(F.col("payload")["query"]))
            .withColumn("_hash", F.when(F.coalesce("_query", F.lit("")) != "", query_fingerprint(F.col("_query")))))
    payload, qhash = F.col("payload"), F.col("_hash")
    mean = F.coalesce(vnumber(payload["mean_time_ms"]), F.lit(0.0))
    return df.select(
        iso_timestamp(F.col("_time"), F.col("ingest_ts")).alias("timestamp"),
        F.coalesce(vget(env["host"]), F.lit(UNKNOWN_HOST)).alias("entity_id"),
        F.lit("database_query").alias("event_type"),
        F.coalesce(vget(env["source"]), F.lit(DEFAULT_SOURCE)).alias("source"),
        F.coalesce(vget(env["environment"]), F.lit(DEFAULT_ENVIRONMENT)).alias("environment"),
        F.format_string("Query executed %s times with avg latency %.2fms.",
                        py_str(payload, "calls", "0"), mean).alias("message"),
        F.coalesce(F.try_variant_get(env["tags"], "$", "map<string,string>"),
                   empty_str_map()).alias("tags"),
        F.when(qhash.isNotNull(),
               F.map_concat(payload, F.create_map(F.lit("query_hash"), qhash.cast("variant"))))
         .otherwise(payload).alias("attributes"),
        vget(payload["trace_id"]).alias("trace_id"),
        row_id(F.col("topic"), F.col("partition"), F.col("offset"), F.lit(0)).alias("id"),
        F.col("ingest_ts").alias("created_at"),
        vget(env["database"]).alias("database"),
        F.col("topic"),
    )


def enrich_queries(events: DataFrame) -> DataFrame:
    """``performance`` = slow / acceptable / good; ``query_type`` = read / write."""
    attrs = F.col("attributes")
    mean = F.coalesce(vnumber(attrs["mean_time_ms"]), F.lit(0.0))
    perf = (F.when(mean > SLOW_MS, "slow").when(mean > ACCEPTABLE_MS, "acceptable")
            .otherwise("good"))
    text = F.lower(F.coalesce(vget(attrs["query"]), F.lit("")))
    qtype = F.when(text.contains("select"), "read").when(text.rlike(WRITE_PATTERN), "write")
    tags = F.map_concat(F.col("tags"), F.create_map(F.lit("performance"), perf))
    return events.withColumn("tags", add_tag(tags, qtype.isNotNull(), "query_type", qtype))


class QueriesProcessor(Processor):
    route = "queries"

    def normalize(self, df: DataFrame) -> DataFrame:
        return normalize_queries(df).select(*EVENT_FIELDS)

    def enrich(self, df: DataFrame) -> DataFrame:
        return enrich_queries(df)
