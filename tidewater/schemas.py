"""Table contracts and the nested input shapes (OTLP JSON)."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Bronze: one raw message per row, whatever the transport.
MESSAGES_DDL = ("topic STRING, `partition` INT, `offset` BIGINT, key STRING, "
                "value STRING, ingest_ts TIMESTAMP")

# Persisted contracts (column order = write order).
EVENTS_COLUMNS = ["timestamp", "entity_id", "event_type", "source", "environment",
                  "message", "tags", "attributes", "trace_id", "id", "created_at"]
METRICS_COLUMNS = ["metric_name", "entity_id", "timestamp", "source", "environment",
                   "metric_value", "metric_type", "unit", "tags", "metadata",
                   "created_at", "id"]
ENTITIES_COLUMNS = ["entity_id", "entity_type", "first_seen", "last_seen", "attributes"]

# Sort keys of the three tables.
EVENTS_SORT = ["entity_id", "timestamp", "event_type"]
METRICS_SORT = ["metric_name", "entity_id", "timestamp"]
ENTITIES_SORT = ["entity_type", "entity_id"]

# OTLP attribute value: both proto (snake) and JSON (camel) spellings.
_ANY_VALUE = ("struct<stringValue:string,string_value:string,intValue:string,"
              "int_value:string,doubleValue:string,double_value:string,"
              "boolValue:string,bool_value:string>")
_ATTRS = f"array<struct<key:string,value:{_ANY_VALUE}>>"
_POINT = (f"struct<time_unix_nano:string,timeUnixNano:string,as_int:string,asInt:string,"
          f"as_double:string,asDouble:string,attributes:{_ATTRS}>")
_POINTS = f"struct<data_points:array<{_POINT}>,dataPoints:array<{_POINT}>>"
_METRIC = (f"struct<name:string,description:string,unit:string,"
           f"gauge:{_POINTS},sum:{_POINTS},histogram:{_POINTS}>")
_SCOPE_METRICS = "struct<scope:struct<name:string,version:string>,metrics:array<" + _METRIC + ">>"

# One ResourceMetrics object (one message on the metrics topic).
OTLP_RESOURCE_METRICS = (f"struct<resource:struct<attributes:{_ATTRS}>,"
                         f"scope_metrics:array<{_SCOPE_METRICS}>,"
                         f"scopeMetrics:array<{_SCOPE_METRICS}>>")

_LOG_RECORD = (f"struct<timeUnixNano:string,observedTimeUnixNano:string,severityText:string,"
               f"severityNumber:string,body:struct<stringValue:string>,attributes:{_ATTRS},"
               f"traceId:string,spanId:string>")
# One OTLP logs export request (one message on the host-logs topic).
OTLP_LOGS = (f"struct<resourceLogs:array<struct<resource:struct<attributes:{_ATTRS}>,"
             f"scopeLogs:array<struct<scope:struct<name:string>,logRecords:array<{_LOG_RECORD}>>>>>>")


def ddl(s: str) -> StructType:
    return StructType.fromDDL(s)
