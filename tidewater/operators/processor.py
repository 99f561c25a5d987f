"""UD1: the processor extension point, as DataFrame → DataFrame stages.

A processor turns the processable messages of one route into silver rows:
``normalize`` (shape), ``enrich`` (computed tags), ``validate`` (rule
violations). ``process`` chains them with ``DataFrame.transform``; nothing is
evaluated until an action runs, so Catalyst sees the whole chain as one plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ProcessorConfig:
    """Flags of the processing pipeline (defaults follow the reference)."""
    enable_enrichment: bool = True
    validate_data: bool = True
    drop_invalid: bool = False
    # flush of the streaming jobs by size or age (service defaults); bytes for file sources
    max_batch_size: int = 100
    max_batch_age_seconds: int = 10
    max_batch_bytes: int = 1 << 30


# Event silver columns: the events contract plus lineage helpers.
EVENT_FIELDS = ["timestamp", "entity_id", "event_type", "source", "environment", "message",
                "tags", "attributes", "trace_id", "id", "created_at", "database", "topic"]
METRIC_FIELDS = ["metric_name", "entity_id", "timestamp", "source", "environment",
                 "metric_value", "metric_type", "unit", "tags", "metadata", "created_at",
                 "id", "topic"]


def _violations(rules: list[tuple[str, Column]]) -> Column:
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
                              for name, ok in rules]), lambda x: x.isNotNull())


def event_rules() -> list[tuple[str, Column]]:
    return [(f"missing:{c}", F.col(c).isNotNull())
            for c in ("timestamp", "entity_id", "event_type", "source", "environment", "message")]


def metric_rules() -> list[tuple[str, Column]]:
    return [
        ("missing:metric_name", F.col("metric_name").isNotNull()),
        ("missing:entity_id", F.col("entity_id").isNotNull()),
        ("bad:metric_type", F.col("metric_type").isin("gauge", "counter", "histogram")),
        ("bad:metric_value", ~F.isnan("metric_value") & (F.abs("metric_value") != float("inf"))),
    ]


class Processor:
    """Base processor: subclass and override ``normalize`` / ``enrich``.

    A processor of a new route names its ``route`` and the ``topics`` that select it;
    their text arrives unparsed in ``value``, and ``reason`` gives the dead-letter reason
    of what it cannot read (NULL: processable).
    """

    kind = "event"
    route = ""
    topics: tuple[str, ...] = ()

    def reason(self) -> Column:
        return F.lit(None).cast("string")

    def __init__(self, config: ProcessorConfig | None = None):
        self.config = config or ProcessorConfig()

    def normalize(self, df: DataFrame) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def enrich(self, df: DataFrame) -> DataFrame:
        return df

    def rules(self) -> list[tuple[str, Column]]:
        return metric_rules() if self.kind == "metric" else event_rules()

    def validate(self, df: DataFrame) -> DataFrame:
        """Add ``violations``; with ``drop_invalid`` keep only clean rows (FP11)."""
        if not self.config.validate_data:
            return df
        out = df.withColumn("violations", _violations(self.rules()))
        if self.config.drop_invalid:
            out = out.where(F.size("violations") == 0)
        return out

    def process(self, df: DataFrame, enrich: bool = True) -> DataFrame:
        out = df.transform(self.normalize)
        if self.config.enable_enrichment and enrich:
            out = out.transform(self.enrich)
        return out.transform(self.validate)


def quarantine(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split validated rows into (clean, invalid)."""
    bad = F.size("violations") > 0
    return validated.where(~bad), validated.where(bad)
