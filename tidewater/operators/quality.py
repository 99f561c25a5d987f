"""Input quality reports (FP22) and statistics snapshots → envelopes (FP23)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.route import DOCUMENT_TOPICS

# Fixed value: fields every custom envelope must carry.
REQUIRED_FIELDS = ["timestamp", "source", "data_type", "host", "database"]


def envelope_completeness(prepared: DataFrame) -> DataFrame:
    """FP22: per topic, messages that are no JSON object and objects lacking each field.

    OTLP messages have not been read as an envelope before; that happens here.
    """
    read = F.coalesce(F.col("env"), F.when(F.col("topic").isin(*DOCUMENT_TOPICS),
                                           F.from_json("value", "map<string,variant>")))
    keys = F.map_keys(read).alias("keys")  # null: not an object
    aggs = [F.count(F.lit(1)).alias("messages"), F.count_if(F.col("keys").isNull()).alias("bad_json")]
    for f in REQUIRED_FIELDS:
        aggs.append(F.count_if(~F.array_contains("keys", f)).alias(f"missing_{f}"))
    return prepared.select("topic", keys).groupBy("topic").agg(*aggs)


def statistics_envelopes(snapshots: DataFrame, source: str = "postgresql") -> DataFrame:
    """FP23: one ``connection_stats`` envelope per snapshot, plus a ``deadlocks``
    warning envelope where the snapshot saw deadlocks.

    ``snapshots``: host, database, environment, timestamp, total, active, idle, deadlocks.
    """
    common = [F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
              F.lit(source).alias("source"), F.lit("log").alias("data_type"), "host", "database",
              "environment"]
    conn = snapshots.select(
        *common, F.struct(F.lit("info").alias("log_level")).alias("tags"),
        F.struct(F.lit("connection_stats").alias("event_type"), "total", "active", "idle").alias("payload"))
    dead = snapshots.where(F.col("deadlocks") > 0).select(
        *common, F.struct(F.lit("warning").alias("log_level")).alias("tags"),
        F.struct(F.lit("deadlocks").alias("event_type"), F.col("deadlocks").alias("count")).alias("payload"))
    return conn.unionByName(dead, allowMissingColumns=True)
