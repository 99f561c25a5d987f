"""Bronze sources: JSON Lines files (SR1), OTLP JSON documents (SR4/SR5),
topic streams (SR2), delimited text tables (SR9) and table scans (SR7/SR8).

Every source yields the bronze message schema
``(topic, partition, offset, key, value, ingest_ts)`` so the same
``prepare`` → processors chain runs on all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.schemas import MESSAGES_DDL
from tidewater.sources.documents import read_elements


COPIES = 10_000  # copies of a line that one row spells out


def _bronze(df: DataFrame, topic, value: str, number: str) -> DataFrame:
    """Files carry no offsets: the file path stands in for the partition, and a hash of the text and
    of its number among equal ones for the offset (K9), so a re-read yields the same ids."""
    t = F.lit(topic) if isinstance(topic, str) or topic is None else topic
    first = F.xxhash64(F.col(value))
    return df.select(
        t.cast("string").alias("topic"),
        F.hash(F.col("_path")).alias("partition"),
        F.when(F.col(number) == 0, first).otherwise(F.xxhash64(F.col(value), F.col(number))).alias("offset"),
        F.lit(None).cast("string").alias("key"),
        F.col(value).alias("value"),
        F.col("_time").alias("ingest_ts"))


FILE = ["_metadata.file_path as _path", "_metadata.file_modification_time as _time"]


def read_json_lines(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """SR1: one JSON message per line (no topic → routed by content).

    Equal lines of a file are different messages: they are counted (with a partial count
    in each task) and numbered from 0, which no split of the file changes. A line with
    many copies is spelt out by rows of ``COPIES``, dealt out anew.
    """
    lines = spark.read.text(path).selectExpr(*FILE, "value")
    counted = lines.groupBy("_path", "_time", "value").agg(F.count(F.lit(1)).alias("copies"))
    few = counted.where(F.col("copies") <= COPIES).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("number"))
    runs = counted.where(F.col("copies") > COPIES).select("*", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))).alias("at")).repartition("at", "value")
    many = runs.select("_path", "_time", "value", "copies", F.explode(F.sequence(
        F.col("at"), F.least(F.col("copies"), F.col("at") + COPIES) - 1)).alias("number"))
    return _bronze(few.unionByName(many), topic, "value", "number")


def read_json_documents(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """SR4/SR5: files holding one JSON document each, either an object or an
    array of objects (e.g. a list of ResourceMetrics); every object becomes a
    message, a large array's in many tasks (``documents.read_elements``)."""
    elements = read_elements(spark, path)
    return _bronze(elements.select(F.col("path").alias("_path"), F.col("time").alias("_time"),
                                   F.col("element").alias("number"), F.col("text").alias("msg")), topic, "msg", "number")


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Bronze messages already stored with the message schema."""
    return spark.read.schema(MESSAGES_DDL).format(fmt).load(path)


def read_topics_stream(spark: SparkSession, bootstrap_servers: str, topics: list[str],
                       starting_offsets: str = "earliest",
                       max_offsets_per_trigger: int | None = None,
                       fail_on_data_loss: bool = True, text: bool = True,
                       options: dict[str, str] | None = None) -> DataFrame:
    """SR2: subscribe to the topics (needs the Kafka connector on the classpath).

    Lost offsets end the query unless the caller chooses otherwise; ``text=False``
    keeps the bytes, as the protobuf metrics topic needs (``otlp_proto.decode_messages``);
    ``options`` as from ``streaming.stream.admission``.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", ",".join(topics))
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()).options(**(options or {})))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string" if text else "binary").alias("value"), F.col("timestamp").alias("ingest_ts"))


def read_messages_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                         max_files_per_trigger: int | None = None,
                         options: dict[str, str] | None = None) -> DataFrame:
    """SR2 stand-in: a directory of bronze message files as a stream."""
    r = spark.readStream.schema(MESSAGES_DDL).format(fmt).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ",",
                   header: bool = False) -> DataFrame:
    """SR9: external delimited text table with declared columns.

    A line that does not fit them keeps its text in ``_corrupt_record`` if the schema declares that column.
    """
    return (spark.read.schema(schema).option("sep", sep).option("header", str(header).lower())
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))
