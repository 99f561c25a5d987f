"""Table sinks and projections (SK1-SK3, SK5-SK9).

Layout: Parquet, partitioned by ``event_date``, range-partitioned and sorted
within files on each table's sort key, so row-group min/max statistics prune
entity and time predicates; Bloom filters serve lookups by entity and id. Beside
the contract's JSON text stand typed columns of the fields that analyses filter
and aggregate, so their predicates reach the scan and no JSON is parsed again.
Micro-batches are written through ``commit_log``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions.expr import vget, vnumber
from tidewater.session import TIDY_CONF, settings, shared_dir
from tidewater.sinks.commit_log import Append
from tidewater.schemas import (ENTITIES_COLUMNS, ENTITIES_SORT, EVENTS_COLUMNS, EVENTS_SORT,
                               METRICS_COLUMNS, METRICS_SORT)

# Processed-topic fan-out.
PROCESSED_TOPICS = {"metrics": "processed-metrics", "logs": "processed-logs",
                    "queries": "processed-queries", "alerts": "alerts"}


# Typed columns: name → (map column, key, type).
EVENT_TYPED = {
    "log_level": ("tags", "log_level", "string"), "requires_alert": ("tags", "requires_alert", "string"),
    "category": ("tags", "category", "string"), "performance": ("tags", "performance", "string"),
    "query_type": ("tags", "query_type", "string"), "payload_type": ("attributes", "event_type", "string"),
    "query_id": ("attributes", "queryid", "string"), "query_text": ("attributes", "query", "string"),
    "query_hash": ("attributes", "query_hash", "string"), "calls": ("attributes", "calls", "bigint"),
    "rows_affected": ("attributes", "rows", "bigint"),
    "total_time_ms": ("attributes", "total_time_ms", "double"),
    "mean_time_ms": ("attributes", "mean_time_ms", "double"), "min_time_ms": ("attributes", "min_time_ms", "double"),
    "max_time_ms": ("attributes", "max_time_ms", "double"),
    "stddev_time_ms": ("attributes", "stddev_time_ms", "double"),
    "cache_hit_ratio": ("attributes", "cache_hit_ratio", "double")}
METRIC_TYPED = {"severity": ("tags", "severity", "string"), "database": ("tags", "database", "string")}
BLOOM = ("entity_id", "id")


def _typed(df: DataFrame, columns: dict[str, tuple[str, str, str]]) -> DataFrame:
    def value(column: str, key: str, kind: str) -> Column:
        if column == "tags":
            return F.col("tags")[key]
        return (vget if kind == "string" else vnumber)(F.col(column)[key], kind)
    return df.select("*", *[value(*spec).alias(name) for name, spec in columns.items() if name not in df.columns])


def typed_events(events: DataFrame) -> DataFrame:
    """Events with their typed columns; those of a stored table have them already."""
    return _typed(events, EVENT_TYPED)


def typed_metrics(metrics: DataFrame) -> DataFrame:
    return _typed(metrics, METRIC_TYPED)


def events_contract(events: DataFrame) -> DataFrame:
    """SK1 shape: 11 contract columns, maps as JSON text, the typed columns and ``event_date``."""
    return typed_events(events).select(
        *[F.to_json(c).alias(c) if c in ("tags", "attributes") else F.col(c) for c in EVENTS_COLUMNS],
        "database", *EVENT_TYPED, F.to_date("timestamp").alias("event_date"))


def metrics_contract(metrics: DataFrame) -> DataFrame:
    """SK2 shape: 12 contract columns, the typed columns and ``event_date``."""
    return typed_metrics(metrics).select(
        *[F.to_json(c).alias(c) if c in ("tags", "metadata") else F.col(c) for c in METRICS_COLUMNS],
        *METRIC_TYPED, F.to_date("timestamp").alias("event_date"))


# Rows of a slice of days that is range-partitioned at once, and slices of a table at most.
SLICE_ROWS = 2_000_000
SLICES = 8
LANDED_ROW_GROUP = 16 << 20  # bytes before compression, so that a slice reads little of other days


def day_slices(rows: DataFrame, column: str) -> list[Column]:
    """Predicates that cut rows into runs of days, each of ``SLICE_ROWS`` rows or 1 / ``SLICES`` of all, or of one day.

    The rows are read once to count them and then once a slice, so they should be stored ones.
    """
    days = [(r[0], r[1]) for r in rows.groupBy(column).agg(F.count(F.lit(1))).collect()]  # a row a day
    days.sort(key=lambda d: (d[0] is not None, d[0]))
    size = max(SLICE_ROWS, sum(n for _, n in days) / SLICES)
    runs, held = [], 0
    for day, n in days:
        if not runs or held + n > size:
            runs.append([])
            held = 0
        runs[-1].append(day)
        held += n
    if len(runs) < 2:
        return [F.lit(True)]
    day = F.col(column)
    return [reduce(Column.__or__, [*([day.isNull()] if run[0] is None else []),
                                   *([day.between(F.lit(known[0]), F.lit(known[-1]))] if known else [])])
            for run in runs for known in [[d for d in run if d is not None]]]


def drop_rows(spark: SparkSession, path: str, schema: StructType) -> None:
    """Empty a landed folder that nothing reads any more: Spark's own overwrite removes its files."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def _write_sorted(df: DataFrame, path: str, sort: list[str], partitions: int | None,
                  mode: str, partition_by: list[str], bloom: tuple[str, ...] = (),
                  split: dict[str, str] | None = None) -> None:
    """SK6: range-partition on (date, sort key) → few files per date, sorted rows.

    The rows are landed first, as they come: the range sampling and the sort then read
    landed columns instead of running the whole normalisation twice. ``split`` are the settings of
    file splits under which ``df`` is run. A large table is sorted in slices of whole days, so that the
    disk holds the shuffle of one slice; the landed rows go when the table is written.
    """
    keys = [*partition_by, *sort]
    spark = df.sparkSession
    landed = shared_dir(spark, "landed")
    with settings(spark, {**(split or {}), **TIDY_CONF}):
        (df.sortWithinPartitions(*partition_by) if partition_by else df).write.mode("overwrite").option(
            "compression", "zstd").option("parquet.block.size", LANDED_ROW_GROUP).parquet(landed)
    rows = spark.read.schema(df.schema).parquet(landed)
    with settings(spark, TIDY_CONF):
        for days in day_slices(rows, partition_by[0]) if partition_by else [F.lit(True)]:
            some = rows.where(days)
            out = some.repartitionByRange(partitions, *keys) if partitions else some.repartitionByRange(*keys)
            w = out.sortWithinPartitions(*keys).write.mode(mode).option("compression", "zstd")
            for column in bloom:
                w = w.option(f"parquet.bloom.filter.enabled#{column}", "true")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(path)
            mode = "append"
    drop_rows(spark, landed, df.schema)


def write_events(events: DataFrame, path: str, partitions: int | None = None,
                 mode: str = "append", split: dict[str, str] | None = None) -> None:
    """SK1."""
    _write_sorted(events_contract(events), path, EVENTS_SORT, partitions, mode, ["event_date"], BLOOM, split)


def write_metrics(metrics: DataFrame, path: str, partitions: int | None = None,
                  mode: str = "append", split: dict[str, str] | None = None) -> None:
    """SK2."""
    _write_sorted(metrics_contract(metrics), path, METRICS_SORT, partitions, mode, ["event_date"], BLOOM, split)


def write_entities(entities_json_df: DataFrame, path: str) -> None:
    """SK3: write a whole entity set to ``path``; merging into a stored one is ``commit_log.Upsert``."""
    _write_sorted(entities_json_df.select(*ENTITIES_COLUMNS), path, ENTITIES_SORT, None,
                  "overwrite", [])


def batch_tables(events: DataFrame, metrics: DataFrame, dead: DataFrame) -> dict[str, Append]:
    """SK4: the tables of one micro-batch, for ``commit_log.commit``."""
    return {"events": Append(events_contract(events), tuple(EVENTS_SORT)),
            "metrics": Append(metrics_contract(metrics), tuple(METRICS_SORT)),
            "dead_letter": Append(dead.withColumn("event_date", F.to_date("ingest_ts")), ("topic", "reason"))}


def read_table(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """SR7 / FP13 / FP16: a stored table, from ``start`` to ``end`` (both inclusive) where given.

    Plain Parquet does not infer ``event_date`` bounds from a timestamp filter,
    so both are stated; the date one prunes directories, the other row groups.
    """
    df = spark.read.parquet(path)
    for bound, sign in ((start, 1), (end, -1)):
        if bound is not None:
            at = F.lit(bound).cast("timestamp")
            day = F.to_date(at)
            df = df.where((F.col("event_date") >= day) & (F.col("timestamp") >= at) if sign > 0
                          else (F.col("event_date") <= day) & (F.col("timestamp") <= at))
    return df


# --- SK8 typed projections ------------------------------------------------------

def db_queries(query_events: DataFrame) -> DataFrame:
    """Typed ``db_queries`` view of query events, in flight or stored."""
    return typed_events(query_events).select(
        "timestamp", F.col("entity_id").alias("host"), F.col("database").alias("database_name"),
        "mean_time_ms", "source", "environment", "query_id", "query_text", "query_hash", "calls", "total_time_ms",
        "min_time_ms", "max_time_ms", "stddev_time_ms", "rows_affected", "cache_hit_ratio", "tags",
        F.col("attributes").alias("metadata"), "created_at")


def db_logs(log_events: DataFrame) -> DataFrame:
    """Typed ``db_logs`` view of log events, in flight or stored."""
    return typed_events(log_events).select(
        "timestamp", F.col("entity_id").alias("host"), F.col("database").alias("database_name"),
        "log_level", "source", "environment", F.coalesce("payload_type", "event_type").alias("event_type"), "message",
        "tags", F.col("attributes").alias("metadata"), "created_at")


def db_metrics(metrics: DataFrame) -> DataFrame:
    """Typed ``db_metrics`` view of metrics, in flight or stored."""
    return typed_metrics(metrics).select(
        "timestamp", F.col("entity_id").alias("host"), F.col("database").alias("database_name"),
        "metric_name", "source", "environment", "metric_value", "metric_type", "unit", "tags", "metadata", "created_at")


# --- SK5 / SK9 keyed publish ----------------------------------------------------

def keyed_frame(envelopes: DataFrame, topic: str | Column) -> DataFrame:
    """SK5: ``key = host:database``, ``value`` = JSON of the remaining fields."""
    t = F.lit(topic) if isinstance(topic, str) else topic
    fields = [c for c in envelopes.columns if c != "topic"]
    return envelopes.select(t.alias("topic"),
                            F.concat_ws(":", F.col("host"), F.col("database")).alias("key"),
                            F.to_json(F.struct(*fields)).alias("value"))


def processed_topic(kind: Column) -> Column:
    """SK9: route a processed row to its output topic."""
    out = None
    for k, v in PROCESSED_TOPICS.items():
        out = F.when(kind == k, F.lit(v)) if out is None else out.when(kind == k, F.lit(v))
    return out


def publish(frame: DataFrame, path: str | None = None, kafka_servers: str | None = None) -> None:
    """Write a (topic, key, value) frame to Kafka, or as JSON files per topic."""
    if kafka_servers:
        (frame.write.format("kafka").option("kafka.bootstrap.servers", kafka_servers).save())
    else:
        frame.write.mode("append").partitionBy("topic").json(path)
