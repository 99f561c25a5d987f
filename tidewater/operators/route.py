"""FP1 routing and FP2 error isolation.

A message is parsed once. Envelopes (queries, logs) become ``map<string,variant>``;
messages of the OTLP routes are parsed straight into their typed document, and only
one without a data point or log record gets a variant parse that tells why. Instead
of raising (which would drop a whole micro-batch), each message that stores nothing
gets an explicit ``reason``; rows with a reason form the dead-letter output, so
stored messages and dead letters add up to the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import is_vnull, is_vnumber, is_vstring, vget, vkind
from tidewater.schemas import OTLP_LOGS, OTLP_RESOURCE_METRICS

# Topic names and the routes they select.
TOPIC_ROUTES = {
    "otel-metrics": "metrics",
    "raw-logs": "logs",
    "raw-host-logs": "host_logs",
    "raw-queries": "queries",
}
ROUTES = ["metrics", "logs", "host_logs", "queries"]
DOCUMENT_ROUTES = {"metrics": OTLP_RESOURCE_METRICS, "host_logs": OTLP_LOGS}
DOCUMENT_TOPICS = [t for t, r in TOPIC_ROUTES.items() if r in DOCUMENT_ROUTES]
CONTENT_ROUTES = ["metrics", "logs", "queries"]  # those that a message without a known topic can have
IGNORED = "ignored"
UNROUTED = "unrouted"
SAMPLE_CHARS = 200


def parse_messages(messages: DataFrame, raw_topics: list[str] | None = None) -> DataFrame:
    """Add ``env`` (the envelope as ``map<string,variant>``), ``payload`` and ``is_json``.

    Each step is its own projection over the previous one, so the JSON text is
    parsed once and the payload converted once per message. Messages of the OTLP
    topics have no envelope and wait for their typed parse; ``raw_topics`` hold
    text of another form and are not parsed at all.
    """
    # JSON objects parse straight into a map (duplicate keys: last wins, as
    # in Python); only rows that are not objects get the variant parse that
    # tells "not JSON" from "JSON but not an object" (OR short-circuits).
    later = F.coalesce(F.col("topic").isin(*DOCUMENT_TOPICS, *(raw_topics or [])), F.lit(False))
    parsed = messages.withColumn("_env", F.when(~later, F.from_json(F.col("value"), "map<string,variant>")))
    is_json = later | F.col("_env").isNotNull() | F.try_parse_json(F.col("value")).isNotNull()
    return _barrier(parsed, is_json=is_json, env=F.col("_env"),
                    payload=F.try_variant_get(F.col("_env")["payload"], "$", "map<string,variant>"),
                    drop=["_env"])


def _barrier(df: DataFrame, drop: list[str] | None = None, **cols: Column) -> DataFrame:
    """Add ``cols`` through a one-row generator.

    Filters on generator output are not pushed below it, so a later
    ``where(reason IS NULL)`` cannot re-inline (and re-run) the JSON parse the
    way alias substitution through a plain projection would.
    """
    keep = [c for c in df.columns if c not in (drop or [])]
    packed = F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))
    return df.select(*keep, F.inline(packed))


def route_column(topic: Column, env: Column, topics: dict[str, str] | None = None) -> Column:
    """Topic first; without a known topic, by content (FP1)."""
    t = F.coalesce(topic, F.lit(""))
    data_type = vget(env["data_type"])
    expr = None
    for name, route in (topics or TOPIC_ROUTES).items():
        expr = F.when(t == name, F.lit(route)) if expr is None else expr.when(t == name, F.lit(route))
    return (expr
            .when(F.coalesce(F.map_contains_key(env, "scope_metrics"), F.lit(False)), F.lit("metrics"))
            .when(F.coalesce(data_type == "log", F.lit(False)), F.lit("logs"))
            .when(F.coalesce(data_type == "query", F.lit(False)), F.lit("queries"))
            .otherwise(F.lit(IGNORED)))


def has_points(doc: Column) -> Column:
    """Whether a ResourceMetrics document holds a data point with a value."""
    def valued(points: Column) -> Column:
        return F.exists(points, lambda p: F.coalesce(p["as_int"], p["asInt"], p["as_double"], p["asDouble"]).isNotNull())

    def in_metric(m: Column) -> Column:
        return valued(F.coalesce(*(m[k][spelling] for k in ("gauge", "sum", "histogram")
                                   for spelling in ("data_points", "dataPoints"))))
    scopes = F.coalesce(doc["scope_metrics"], doc["scopeMetrics"])
    return F.coalesce(F.exists(scopes, lambda s: F.coalesce(F.exists(s["metrics"], lambda m: F.coalesce(
        in_metric(m), F.lit(False))), F.lit(False))), F.lit(False))


def has_records(doc: Column) -> Column:
    """Whether an OTLP logs document holds a log record."""
    return F.coalesce(F.exists(doc["resourceLogs"], lambda r: F.coalesce(F.exists(
        r["scopeLogs"], lambda s: F.coalesce(F.size(s["logRecords"]) > 0, F.lit(False))), F.lit(False))), F.lit(False))


def document_reason(value: Column, keys: list[str], empty: str) -> Column:
    """Why a document of an OTLP route stores nothing; ``keys`` are the spellings of its array."""
    whole = F.try_parse_json(value)
    fields = F.try_variant_get(whole, "$", "map<string,variant>")
    found = F.coalesce(*(fields[k] for k in keys))
    items = F.try_variant_get(found, "$", "array<variant>")
    return (F.when(whole.isNull(), F.lit("not_json"))
            .when(fields.isNull(), F.lit("not_object"))
            .when(found.isNull(), F.lit(f"missing:{keys[0]}"))
            .when(items.isNull(), F.lit(f"bad_type:{keys[0]}"))
            .when(F.size(items) == 0, F.lit(f"empty:{keys[0]}"))
            .otherwise(F.lit(empty)))


def _present(m: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(m, key), F.lit(False))


def _null_field(env: Column, key: str) -> Column:
    return F.when(is_vnull(env[key]), F.lit(f"null_field:{key}"))


def _bad_type(ok: Column, m: Column, key: str) -> Column:
    """Reason when ``key`` is present (null included) and ``ok`` is false."""
    return F.when(~F.coalesce(ok, F.lit(False)) & _present(m, key), F.lit(f"bad_type:{key}"))


def _flat_tags(env: Column) -> Column:
    """Tags must be an object of scalars (numbers become text).

    The object test is the map conversion itself (NULL for anything else);
    only the values' kinds are inspected, not the schema of the whole object.
    """
    tags = F.try_variant_get(env["tags"], "$", "map<string,variant>")
    nested = F.exists(F.map_values(tags),
                      lambda x: vkind(x).startswith("OBJECT") | vkind(x).startswith("ARRAY"))
    return tags.isNotNull() & ~F.coalesce(nested, F.lit(False))


def reason_column(route: Column, env: Column, is_json: Column, payload: Column, value: Column,
                  full: dict[str, Column], flat_tags: Column, checks: dict[str, Column] | None = None) -> Column:
    """First failed rule for a message, or NULL when it is processable.

    ``full`` tells whether a document of an OTLP route stores anything, ``flat_tags`` whether
    an envelope's tags are an object of scalars, ``checks`` are the reasons that added routes
    give themselves.
    """
    envelope_nulls = [_null_field(env, k) for k in ("host", "source", "environment", "payload", "tags")]
    logs_rules = envelope_nulls + [
        _bad_type(payload.isNotNull(), env, "payload"),
        _bad_type(flat_tags, env, "tags"),
        _bad_type(is_vstring(payload["event_type"]), payload, "event_type"),
    ]
    query_rules = envelope_nulls + [
        _bad_type(payload.isNotNull(), env, "payload"),
        _bad_type(flat_tags, env, "tags"),
        _bad_type(is_vstring(payload["query"]), payload, "query"),
        _bad_type(is_vnumber(payload["mean_time_ms"]), payload, "mean_time_ms"),
    ]

    out = F.when(~is_json, F.lit("not_json"))
    for name, check in (checks or {}).items():
        out = out.when(route == name, check)
    return (out.when(route == "metrics", F.when(~full["metrics"], document_reason(
                value, ["scope_metrics", "scopeMetrics"], "no_points")))
            .when(route == "host_logs", F.when(~full["host_logs"], document_reason(
                value, ["resourceLogs"], "empty:logRecords")))
            .when(env.isNull(), F.lit("not_object"))
            .when(route == IGNORED, F.lit(UNROUTED))
            .when(route == "logs", F.coalesce(*logs_rules))
            .when(route == "queries", F.coalesce(*query_rules)))


def prepare(messages: DataFrame, topics: dict[str, str] | None = None,
            checks: dict[str, Column] | None = None, only: str | None = None) -> DataFrame:
    """Bronze messages → parsed, routed, with a dead-letter ``reason``.

    ``topics`` and ``checks`` add routes to the built-in ones: the topics that select
    them (their text is not parsed here) and the reason why a message is not processable.
    ``only`` names the one route that is wanted: messages of others are left out as soon as
    they are routed, and with the route constant its steps and rules alone stay in the plan.
    """
    extra = topics or {}
    p = parse_messages(messages, list(extra))
    p = p.withColumn("_route", route_column(F.col("topic"), F.col("env"), {**TOPIC_ROUTES, **extra}))
    if only:
        p = p.where(F.col("_route") == only)
    route = F.lit(only) if only else F.col("_route")
    docs = {f"{r}_doc": F.when(route == r, F.from_json(F.col("value"), shape)) for r, shape in DOCUMENT_ROUTES.items()}
    if only is None:
        p = _barrier(p, route=route, drop=["_route"], **docs)
    else:  # the constant stays outside the barrier; an envelope has no document to hold behind one
        p = _barrier(p, **docs) if only in DOCUMENT_ROUTES else p.withColumns(docs)
        p = p.drop("_route").withColumn("route", route)
    # the array functions stand apart: they have no generated code, and beside them the rules would have none;
    # the rules need no barrier, as all parses stand behind one
    p = _barrier(p, flat_tags=F.when(F.col("route").isin("logs", "queries"), _flat_tags(F.col("env"))),
                 **{f"{r}_full": F.when(F.col("route") == r, holds(F.col(f"{r}_doc")))
                    for r, holds in (("metrics", has_points), ("host_logs", has_records))})
    return p.withColumn("reason", reason_column(
        F.col("route"), F.col("env"), F.col("is_json"), F.col("payload"), F.col("value"),
        {r: F.col(f"{r}_full") for r in DOCUMENT_ROUTES}, F.col("flat_tags"), checks)).drop(
        "flat_tags", *(f"{r}_full" for r in DOCUMENT_ROUTES))


def topic_prefilter(route: str, topics: dict[str, str] | None = None) -> Column:
    """Cheap bronze predicate: the route's own topics or, if content can select it, unknown ones.

    It only reads ``topic``, so Catalyst pushes it below the parse (through the
    generator barriers, down to the scan); each route branch then parses only
    its own messages instead of every topic's.
    """
    every = {**TOPIC_ROUTES, **(topics or {})}
    own = [t for t, r in every.items() if r == route]
    if route not in CONTENT_ROUTES:
        return F.col("topic").isin(*own)
    known = F.coalesce(F.col("topic").isin(*every), F.lit(False))
    return F.col("topic").isin(*own) | ~known


def routed(prepared: DataFrame, route: str, topics: dict[str, str] | None = None) -> DataFrame:
    """Processable messages of one route."""
    return prepared.where(topic_prefilter(route, topics) & (F.col("route") == route)
                          & F.col("reason").isNull())


def dead_letter(prepared: DataFrame) -> DataFrame:
    """Failed messages with the reason and a 200-character sample (FP2)."""
    return prepared.where(F.col("reason").isNotNull()).select(
        "topic", "partition", "offset", "route", "reason",
        F.substring("value", 1, SAMPLE_CHARS).alias("sample"), "ingest_ts")


def route_counts(prepared: DataFrame) -> DataFrame:
    """Messages per route, split into processable and rejected."""
    return (prepared.groupBy("route")
            .agg(F.count(F.lit(1)).alias("messages"),
                 F.count_if(F.col("reason").isNull()).alias("accepted"),
                 F.count_if(F.col("reason").isNotNull()).alias("rejected")))
