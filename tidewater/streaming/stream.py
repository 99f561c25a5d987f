"""Structured Streaming jobs (ST1-ST10).

The stream runs the same DataFrame functions as the batch jobs:

* ST1/ST3/SK4 ``start_normalisation``: bronze stream → ``foreachBatch`` →
  ``process`` → one commit of events, metrics, dead letters, entities and counts;
* ST2 size-or-age flush: ``trigger(processingTime=max_age)``, and ``admission``
  for what a source lets into one micro-batch;
* ST4 delivery: the checkpoint stores offsets, ids are deterministic (K9), and the
  commit log shows each batch whole, once, however often it is replayed;
* ST5 drain: ``trigger(availableNow=True)`` processes what is there, then stops;
* ST6 windowed aggregation with a watermark; ST7 ``dropDuplicatesWithinWatermark``;
  ``progress_rows`` tells what each batch dropped;
* ST8/ST9 ``start_alerts``: alert and slow-query messages keyed ``host:database``,
  published once per (batch, key);
* ST10 running entity catalogue: each batch's entities are merged into the buckets
  of the stored set that they touch (AG3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.expr import epoch_micros
from tidewater.operators import analytics as an
from tidewater.operators import entities as ent
from tidewater.operators.processor import ProcessorConfig
from tidewater.plans.pipeline import process
from tidewater.sinks import commit_log as log
from tidewater.sinks import tables as sk

STATS = "batch_id BIGINT, events BIGINT, metrics BIGINT, dead_letters BIGINT, size BIGINT, is_empty BOOLEAN"


def _trigger(writer, available_now: bool, max_age_seconds: int):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{int(max_age_seconds)} seconds")


def admission(config: ProcessorConfig, source: str) -> dict[str, str]:
    """ST2: what the source lets into one micro-batch, from the configured size and age.

    A topic waits for ``max_batch_size`` messages or ``max_batch_age_seconds``, whichever
    comes first; files are taken up to ``max_batch_bytes``.
    """
    if source == "kafka":
        return {"minOffsetsPerTrigger": str(config.max_batch_size),
                "maxTriggerDelay": f"{config.max_batch_age_seconds}s"}
    return {"maxBytesPerTrigger": str(config.max_batch_bytes)}


def start_normalisation(messages: DataFrame, out_dir: str, checkpoint: str,
                        config: ProcessorConfig | None = None, available_now: bool = False,
                        entities: bool = True) -> StreamingQuery:
    """ST1: normalise every micro-batch into events / metrics / dead letters / entities."""
    cfg = config or ProcessorConfig()
    w = messages.writeStream.foreachBatch(lambda df, batch_id: normalise_batch(df, batch_id, out_dir, cfg, entities))
    return _trigger(w.option("checkpointLocation", checkpoint), available_now, cfg.max_batch_age_seconds).start()


def normalise_batch(df: DataFrame, batch_id: int, out_dir: str, config: ProcessorConfig | None = None,
                    entities: bool = True) -> bool:
    """One micro-batch, committed whole; False if it was committed before.

    Entities and counts come from the staged rows, so each message is normalised once.
    """
    spark = df.sparkSession
    df = df.persist()  # the routes below read the batch once, not once each
    try:
        out = process(df, config)
        tables = sk.batch_tables(out.events, out.metrics, out.dead_letter)
        if entities:
            tables["entities"] = lambda staged: log.Upsert(ent.derive_entities(
                ent.entity_records(staged["events"], staged["metrics"])), "entity_id", ent.upsert_entities)

        def stats(staged: dict[str, DataFrame]) -> log.Append:
            """AG9: counts from the footers of the staged files, no extra pass over the batch."""
            events, metrics, dead = (staged[k].count() for k in ("events", "metrics", "dead_letter"))
            row = [(int(batch_id), events, metrics, dead, events + metrics, events + metrics == 0)]
            return log.Append(spark.createDataFrame(row, STATS).withColumn("event_date", F.current_date()))

        return log.commit(spark, out_dir, int(batch_id), {**tables, "batch_stats": stats})
    finally:
        df.unpersist()


def start_alerts(messages: DataFrame, out_dir: str, checkpoint: str, config: ProcessorConfig | None = None,
                 available_now: bool = False) -> StreamingQuery:
    """ST8 / ST9: alert and slow-query messages of every micro-batch, under a checkpoint of their own."""
    cfg = config or ProcessorConfig()

    def batch(df: DataFrame, batch_id: int) -> None:
        out = process(df, cfg)
        log.commit(df.sparkSession, out_dir, int(batch_id), {
            "alerts": log.Append(alert_messages(out.events, out.metrics), ("key",)),
            "slow_queries": log.Append(slow_query_messages(out.events), ("key",))})

    w = messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, cfg.max_batch_age_seconds).start()


def progress_rows(query: StreamingQuery) -> list[tuple[int, int, int, int]]:
    """(batch_id, input rows, rows later than the watermark, duplicates) of the query's recent batches.

    For a windowed aggregation the late count is of partial aggregates, as Spark reports it.
    """
    out = []
    for p in query.recentProgress:
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        copies = sum(int((s.customMetrics or {}).get("numDroppedDuplicateRows", 0)) for s in p.stateOperators)
        out.append((p.batchId, p.numInputRows, late, copies))
    return out


def windowed_metrics(metrics: DataFrame, width: str = "5 minutes", slide: str | None = None,
                     watermark: str = "10 minutes") -> DataFrame:
    """ST6: tumbling (or sliding) window aggregation; rows later than the watermark are dropped."""
    return an.rollup(metrics.withWatermark("timestamp", watermark), width, slide)


def dedup_stream(df: DataFrame, key: str = "id", watermark: str = "10 minutes") -> DataFrame:
    """ST7: drop replays of the same id arriving within the watermark."""
    return df.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark([key])


def _key() -> F.Column:
    return F.concat_ws(":", F.col("entity_id"), F.coalesce("database", F.lit("")))


def slow_query_messages(events: DataFrame, threshold_ms: float = an.SLOW_QUERY_MS) -> DataFrame:
    """ST9: query events over the latency threshold, as keyed JSON messages."""
    slow = sk.typed_events(events).where((F.col("event_type") == "database_query") & (F.col("mean_time_ms") > threshold_ms))
    return slow.select(F.lit("slow-queries").alias("topic"), _key().alias("key"),
                       F.to_json(F.struct(epoch_micros(F.col("timestamp")).alias("time_us"), "entity_id", "message",
                                          "query_hash", "mean_time_ms")).alias("value"),
                       F.to_date("timestamp").alias("event_date"))


def alert_messages(events: DataFrame, metrics: DataFrame) -> DataFrame:
    """ST8: one keyed message per triggered enrichment rule, on the ``alerts`` topic."""
    a = an.alert_rows(events, metrics)
    return a.select(F.lit(sk.PROCESSED_TOPICS["alerts"]).alias("topic"), _key().alias("key"),
                    F.to_json(F.struct(epoch_micros(F.col("timestamp")).alias("time_us"), "entity_id", "rule")).alias("value"),
                    F.to_date("timestamp").alias("event_date"))


def run_to_table(df: DataFrame, checkpoint: str, mode: str = "append") -> tuple[DataFrame, StreamingQuery]:
    """Drain a streaming DataFrame into a Parquet folder with ``availableNow``; (its rows, the ended query)."""
    path = checkpoint.rstrip("/") + "-out"
    q = (df.writeStream.format("parquet").outputMode(mode).option("path", path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.parquet(path), q
