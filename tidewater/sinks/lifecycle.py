"""Life of the stored tables: created by DDL, recreated, listed, aged and asked for known ids (SK6, SK7, SK10, SK11).

Tables are catalog tables: partitioned by day, and ``events`` and ``metrics`` in
buckets of the entity, sorted as analyses read them. Ageing removes whole days by
metadata, so no file of a kept day is opened or rewritten.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.analytics import RETENTION_DAYS
from tidewater.session import TIDY_CONF, settings
from tidewater.sinks import tables as sk

# Tables of earlier releases that a recreation removes too.
OLD_TABLES = ["db_logs", "db_queries", "db_metrics"]
BUCKETS = 8

_EVENT_TYPED = ", ".join(f"{name} {kind}" for name, (_, _, kind) in sk.EVENT_TYPED.items())
_METRIC_TYPED = ", ".join(f"{name} {kind}" for name, (_, _, kind) in sk.METRIC_TYPED.items())
COLUMNS = {
    "events": "timestamp timestamp, entity_id string, event_type string, source string, environment string, "
              "message string, tags string, attributes string, trace_id string, id string, created_at timestamp, "
              f"database string, {_EVENT_TYPED}, event_date date",
    "metrics": "metric_name string, entity_id string, timestamp timestamp, source string, environment string, "
               "metric_value double, metric_type string, unit string, tags string, metadata string, "
               f"created_at timestamp, id string, {_METRIC_TYPED}, event_date date",
    "entities": "entity_id string, entity_type string, first_seen timestamp, last_seen timestamp, attributes string"}
LAYOUT = {
    "events": f"PARTITIONED BY (event_date) CLUSTERED BY (entity_id) SORTED BY (entity_id, timestamp) INTO {BUCKETS} BUCKETS",
    "metrics": f"PARTITIONED BY (event_date) CLUSTERED BY (entity_id) SORTED BY (metric_name, entity_id) INTO {BUCKETS} BUCKETS",
    "entities": ""}


def create_tables(spark: SparkSession, schema: str, location: str | None = None, recreate: bool = False) -> None:
    """Create the schema and its tables where they are missing; ``recreate`` empties them first."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}{place}")
    if recreate:
        drop_tables(spark, schema, [*COLUMNS, *OLD_TABLES])
    for name, columns in COLUMNS.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{name} ({columns}) USING parquet {LAYOUT[name]}")


def drop_tables(spark: SparkSession, schema: str, names: list[str]) -> None:
    """Drop tables with their files; missing ones are ignored."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)


def insert(rows: DataFrame, schema: str, name: str) -> None:
    """Append rows: one task a bucket, so each day gets one sorted file a bucket.

    Large tables go in slices of whole days, so that the disk holds the shuffle of one slice; ``rows``
    are read once a slice and should be stored ones.
    """
    spark = rows.sparkSession
    rows = rows.select(*spark.table(f"{schema}.{name}").columns)
    with settings(spark, {**TIDY_CONF, "spark.sql.parquet.compression.codec": "zstd"}):
        for days in sk.day_slices(rows, "event_date") if LAYOUT[name] else [F.lit(True)]:
            some = rows.where(days)
            if LAYOUT[name]:
                some = some.repartition(BUCKETS, "entity_id")
            some.write.insertInto(f"{schema}.{name}")


# --- SK10: ageing -----------------------------------------------------------------

def store_messages(messages: DataFrame, table: str) -> None:
    """Bronze messages as a catalog table with a partition for each topic and day.

    An empty topic has no partition name of its own, so it is stored as ``-``.
    """
    topic = F.coalesce(F.nullif("topic", F.lit("")), F.lit("-"))
    (messages.withColumn("topic", topic).withColumn("day", F.to_date("ingest_ts"))
     .repartition("topic", "day").write.partitionBy("topic", "day").saveAsTable(table))


def age_messages(spark: SparkSession, table: str, as_of: str,
                 days: dict[str, int] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Drop the days that are wholly older than their topic's retention; (rows kept, days dropped by topic).

    The day of the cut stays on disk and is filtered by time. Topics without a retention
    keep everything. The partition list is metadata: topics times days.
    """
    days = RETENTION_DAYS if days is None else days
    cuts = {t: dt.datetime.fromisoformat(as_of) - dt.timedelta(days=d) for t, d in days.items()}
    dropped = dict.fromkeys(days, 0)
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        topic, day = (part.split("=", 1)[1] for part in row[0].split("/"))
        if topic in cuts and dt.date.fromisoformat(day) < cuts[topic].date():
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (topic = '{topic}', day = DATE '{day}')")
            dropped[topic] += 1
    rows = spark.table(table)
    young: Column = ~F.col("topic").isin(*days)
    for topic, cut in cuts.items():
        young = young | ((F.col("topic") == topic) & (F.col("day") >= F.lit(cut.date()))
                         & (F.col("ingest_ts") >= F.lit(cut.isoformat(" ")).cast("timestamp")))
    return rows.where(young), dropped


# --- SK11: ids that are stored already --------------------------------------------

def absent_rows(stored: DataFrame, new: DataFrame, key: str = "id", date: str = "event_date") -> DataFrame:
    """Rows of ``new``, one a key, whose key the stored table does not hold.

    An id belongs to one message and so to one day: only the stored days of the new rows
    are read, and of them only the id column. The semi join sends new keys as a runtime
    filter to that scan; the new rows then meet just the ids that are there.
    """
    days = [r[0] for r in new.select(date).distinct().collect()]  # as many as days in the new rows
    held = (stored.where(F.col(date).isin(days)).select(key)
            .join(new.select(key), key, "left_semi"))
    return new.dropDuplicates([key]).join(held, key, "left_anti")
