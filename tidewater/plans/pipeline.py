"""The normalisation job: bronze messages → silver events / metrics / dead letters.

``process`` is a pure DataFrame → DataFrames function; batch jobs call it on a
file scan, the stream calls it inside ``foreachBatch`` on each micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from tidewater.operators.logs import HostLogsProcessor, LogsProcessor
from tidewater.operators.metrics import MetricsProcessor
from tidewater.operators.processor import EVENT_FIELDS, Processor, ProcessorConfig
from tidewater.operators.queries import QueriesProcessor
from tidewater.operators.route import dead_letter, prepare, routed
from tidewater.sources.syslog import SyslogProcessor


def default_processors(config: ProcessorConfig | None = None) -> dict[str, Processor]:
    """Route → processor registry; pass your own dict to extend it (UD1)."""
    return {"queries": QueriesProcessor(config), "logs": LogsProcessor(config),
            "host_logs": HostLogsProcessor(config), "metrics": MetricsProcessor(config),
            "syslog": SyslogProcessor(config)}


@dataclass
class Outputs:
    prepared: DataFrame
    events: DataFrame
    metrics: DataFrame
    dead_letter: DataFrame


def union_events(frames: list[DataFrame]) -> DataFrame:
    """UN1: event branches appended into one event stream."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [f.select(*EVENT_FIELDS, *[c for c in f.columns if c not in EVENT_FIELDS])
                   for f in frames])


def added_topics(processors: dict[str, Processor]) -> dict[str, str]:
    """Topic → route of the processors that bring their own topics."""
    return {t: route for route, p in processors.items() for t in p.topics}


def prepare_for(messages: DataFrame, processors: dict[str, Processor], only: str | None = None) -> DataFrame:
    return prepare(messages, added_topics(processors),
                   {route: p.reason() for route, p in processors.items() if p.topics}, only)


def process(messages: DataFrame, config: ProcessorConfig | None = None,
            processors: dict[str, Processor] | None = None) -> Outputs:
    """Every route's rows; a registry without event or metric processors gives that table empty."""
    procs = processors or default_processors(config)
    topics, prepared = added_topics(procs), prepare_for(messages, procs)
    tables: dict[str, list[DataFrame]] = {"event": [], "metric": []}
    for route, proc in procs.items():
        tables[proc.kind].append(proc.process(routed(prepared, route, topics)))
    for kind, route in (("event", "logs"), ("metric", "metrics")):
        if not tables[kind]:
            tables[kind].append(default_processors(config)[route].process(routed(prepared, route)).limit(0))
    metrics = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables["metric"])
    return Outputs(prepared, union_events(tables["event"]), metrics, dead_letter(prepared))


def route_events(messages: DataFrame, route: str, config: ProcessorConfig | None = None,
                 enrich: bool = True) -> DataFrame:
    """Silver rows of a single route (one processor, one branch of the plan)."""
    procs = default_processors(config)
    return procs[route].process(routed(prepare_for(messages, procs, route), route, added_topics(procs)), enrich=enrich)
