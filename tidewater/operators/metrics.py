"""FP7 OTLP metric flattening, FP10 metric enrichment, FP12 resource upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import (DEFAULT_ENVIRONMENT, DEFAULT_SOURCE, UNKNOWN_METRIC_HOST,
                                      add_tag, kv_map, nanos_timestamp, row_id, to_number)
from tidewater.operators.processor import METRIC_FIELDS, Processor


def _points(kind: Column) -> Column:
    return F.coalesce(kind["data_points"], kind["dataPoints"])


def metric_points(df: DataFrame) -> DataFrame:
    """One row per (resource, scope, metric, data point) of prepared ResourceMetrics messages.

    Resource attributes are reduced to a map before the explode, so the wide
    nested document is not copied onto every point row.
    """
    doc = F.col("metrics_doc")
    base = df.select("topic", "partition", "offset", "ingest_ts",
                     kv_map(doc["resource"]["attributes"], with_int=True).alias("res"),
                     F.coalesce(doc["scope_metrics"], doc["scopeMetrics"]).alias("scopes"))
    m = (base.select("*", F.posexplode("scopes").alias("si", "sm")).drop("scopes")
             .select("*", F.posexplode("sm.metrics").alias("mi", "m")).drop("sm"))
    # first present kind wins: gauge, then sum, then histogram
    kind = (F.when(F.col("m.gauge").isNotNull(), F.lit("gauge"))
            .when(F.col("m.sum").isNotNull(), F.lit("counter"))
            .when(F.col("m.histogram").isNotNull(), F.lit("histogram")))
    pts = (F.when(F.col("m.gauge").isNotNull(), _points(F.col("m.gauge")))
           .when(F.col("m.sum").isNotNull(), _points(F.col("m.sum")))
           .when(F.col("m.histogram").isNotNull(), _points(F.col("m.histogram"))))
    return (m.select("topic", "partition", "offset", "ingest_ts", "res", "si", "mi",
                     F.col("m.name").alias("name"), F.col("m.description").alias("description"),
                     F.col("m.unit").alias("unit"), kind.alias("metric_type"),
                     F.posexplode(F.coalesce(pts, F.array())).alias("pi", "p")))


def normalize_metrics(df: DataFrame, resource_upserts: dict[str, str] | None = None) -> DataFrame:
    """FP7: metric data points → ``metrics`` rows (points without a number are skipped).

    ``resource_upserts`` applies a collector-style resource upsert (FP12) first.
    """
    p = metric_points(df)
    if resource_upserts:
        p = upsert_resource_attributes(p, resource_upserts, "res")
    as_int = F.coalesce(F.col("p.as_int"), F.col("p.asInt"))
    as_double = F.coalesce(F.col("p.as_double"), F.col("p.asDouble"))
    raw = F.when(F.coalesce(as_int, F.lit("")) != "", as_int).otherwise(as_double)
    value = to_number(raw)
    ns = F.coalesce(F.col("p.time_unix_nano"), F.col("p.timeUnixNano"), F.lit("0"))
    res = F.col("res")
    return (p.where(F.col("metric_type").isNotNull() & value.isNotNull()).select(
        F.coalesce(F.col("name"), F.lit("unknown")).alias("metric_name"),
        F.coalesce(res["host.name"], F.lit(UNKNOWN_METRIC_HOST)).alias("entity_id"),
        nanos_timestamp(ns, F.col("ingest_ts")).alias("timestamp"),
        F.coalesce(res["db.system"], F.lit(DEFAULT_SOURCE)).alias("source"),
        F.coalesce(res["deployment.environment"], F.lit(DEFAULT_ENVIRONMENT)).alias("environment"),
        value.alias("metric_value"),
        F.col("metric_type"),
        F.col("unit"),
        kv_map(F.col("p.attributes")).alias("tags"),
        F.create_map(F.lit("description"),
                     F.coalesce(F.col("description"), F.lit("")).cast("variant")).alias("metadata"),
        F.col("ingest_ts").alias("created_at"),
        row_id(F.col("topic"), F.col("partition"), F.col("offset"),
               F.concat_ws(".", "si", "mi", "pi")).alias("id"),
        F.col("topic")))


def enrich_metrics(metrics: DataFrame) -> DataFrame:
    """FP10: ``severity=warning`` for positive values of error-named metrics."""
    cond = F.col("metric_name").contains("error") & (F.col("metric_value") > 0)
    return metrics.withColumn("tags", add_tag(F.col("tags"), cond, "severity", "warning"))


def upsert_resource_attributes(df: DataFrame, attrs: dict[str, str],
                               column: str = "res") -> DataFrame:
    """FP12: set (insert or overwrite) resource attributes on a map column."""
    kv = []
    for k, v in attrs.items():
        kv += [F.lit(k), F.lit(v)]
    return df.withColumn(column, F.map_concat(F.col(column), F.create_map(*kv)))


class MetricsProcessor(Processor):
    route = "metrics"
    kind = "metric"

    def __init__(self, config=None, resource_upserts: dict[str, str] | None = None):
        super().__init__(config)
        self.resource_upserts = resource_upserts

    def normalize(self, df: DataFrame) -> DataFrame:
        return normalize_metrics(df, self.resource_upserts).select(*METRIC_FIELDS)

    def enrich(self, df: DataFrame) -> DataFrame:
        return enrich_metrics(df)
