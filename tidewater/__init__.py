"""tidewater: a Spark-native telemetry normalisation and analytics engine.

Raw telemetry messages (JSON envelopes, OTLP metrics/logs, syslog lines) are
normalised into unified ``events``, ``metrics`` and ``entities`` tables with
DataFrame operations; the same functions serve batch jobs and Structured
Streaming micro-batches.
"""

from tidewater.session import configure, get_session, shared_dir

__all__ = ["configure", "get_session", "shared_dir"]
