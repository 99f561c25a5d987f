"""SR6: RFC 3164 syslog lines → ``syslog`` events (FP5's event shape)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import DEFAULT_ENVIRONMENT, facility, row_id, severity
from tidewater.operators.processor import EVENT_FIELDS, Processor

# Fixed value: <PRI>Mmm dd HH:MM:SS host tag[pid]: message
RFC3164 = (r"^<(\d{1,3})>([A-Z][a-z]{2}\s+\d{1,2}\s\d{2}:\d{2}:\d{2})\s(\S+)\s"
           r"([^:\[\s]+)(?:\[(\d+)\])?:\s?(.*)$")


def parse_syslog(lines: DataFrame, value: str = "value") -> DataFrame:
    """Split lines into pri / facility / severity / time text / host / tag / pid / msg.

    RFC 3164 carries no year; the one that puts the stamp nearest ``ingest_ts`` is taken.
    """
    v = F.col(value)
    g = lambda i: F.regexp_extract(v, RFC3164, i)
    pri = F.nullif(g(1), F.lit("")).try_cast("int")
    stamp = F.regexp_replace(g(2), r"\s+", " ")
    years = [F.try_to_timestamp(F.concat_ws(" ", (F.year("ingest_ts") + d).cast("string"), stamp),
                                F.lit("yyyy MMM d HH:mm:ss")) for d in (-1, 0, 1)]
    away = [F.abs(F.unix_timestamp(t) - F.unix_timestamp("ingest_ts")) for t in years]
    ts = F.array_min(F.filter(F.array(*[F.struct(a.alias("away"), t.alias("ts")) for a, t in zip(away, years)]),
                              lambda x: x["ts"].isNotNull()))["ts"]
    return lines.select(
        "*", pri.alias("pri"), facility(pri).alias("facility"), severity(pri).alias("severity"),
        F.coalesce(ts, F.col("ingest_ts")).alias("ts"),
        F.nullif(g(3), F.lit("")).alias("host"), F.nullif(g(4), F.lit("")).alias("app"),
        F.nullif(g(5), F.lit("")).alias("pid"), g(6).alias("msg"),
        pri.isNotNull().alias("parsed"))


SYSLOG_TOPIC = "syslog"


class SyslogProcessor(Processor):
    """Lines on the syslog topic; what is no RFC 3164 line is a dead letter."""
    route = "syslog"
    topics = (SYSLOG_TOPIC,)

    def __init__(self, config=None, resource_attributes: dict[str, str] | None = None):
        super().__init__(config)
        self.resource_attributes = resource_attributes

    def reason(self):
        return F.when(~F.coalesce(F.col("value").rlike(RFC3164), F.lit(False)), F.lit("not_syslog"))

    def normalize(self, df: DataFrame) -> DataFrame:
        return syslog_events(df, self.resource_attributes).select(*EVENT_FIELDS)


def unparsed_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The lines ``syslog_events`` cannot read, with the reason, for the dead letters."""
    return parse_syslog(lines, value).where("not parsed").select(*lines.columns, F.lit("not_syslog").alias("reason"))


def syslog_events(lines: DataFrame, resource_attributes: dict[str, str] | None = None) -> DataFrame:
    """Parsed syslog lines → events; ``resource_attributes`` are upserted (FP12)."""
    attrs = resource_attributes or {}
    p = parse_syslog(lines).where("parsed")
    tags = F.map_filter(F.create_map(
        F.lit("facility"), F.col("facility").cast("string"),
        F.lit("severity"), F.col("severity").cast("string"),
        F.lit("appname"), F.col("app"),
        F.lit("proc_id"), F.col("pid")), lambda k, x: x.isNotNull())
    for k, val in attrs.items():
        tags = F.map_concat(tags, F.create_map(F.lit(k), F.lit(val)))
    return p.select(
        F.col("ts").alias("timestamp"),
        F.col("host").alias("entity_id"),
        F.lit("syslog").alias("event_type"),
        F.lit("syslog").alias("source"),
        F.lit(attrs.get("deployment.environment", DEFAULT_ENVIRONMENT)).alias("environment"),
        F.col("msg").alias("message"),
        tags.alias("tags"),
        F.transform_values(tags, lambda k, x: x.cast("variant")).alias("attributes"),
        F.lit(None).cast("string").alias("trace_id"),
        row_id(F.lit("syslog"), *(F.col(c) for c in ("topic", "partition") if c in lines.columns),
               F.col("offset")).alias("id"),
        F.col("ingest_ts").alias("created_at"),
        F.lit(None).cast("string").alias("database"),
        F.lit("syslog").alias("topic"))
