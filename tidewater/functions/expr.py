"""Column expressions shared by the normalisation jobs (SC1-SC12).

Every helper returns a ``Column`` built from built-in functions, so it stays
inside whole-stage code generation; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's rules.
UNKNOWN_HOST = "unknown"                    # custom log / query envelope without host
UNKNOWN_SYSLOG_HOST = "unknown_syslog_host"  # OTLP log record without host.name
UNKNOWN_METRIC_HOST = "unknown_host"         # OTLP metric resource without host.name
DEFAULT_SOURCE = "unknown"
DEFAULT_ENVIRONMENT = "production"
DEFAULT_LOG_LEVEL = "info"
ALERT_LEVELS = ["error", "critical", "alert", "emergency"]
METRIC_TYPES = {"gauge": "gauge", "sum": "counter", "histogram": "histogram"}

# Whitespace class equal to Python's str.split() with no argument.
PY_WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
ISO_PREFIX = r"^\s*\d{4}-\d{2}-\d{2}"
NUMERIC_VARIANT = r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE|BOOLEAN)"


# --- variant access -----------------------------------------------------------

def vget(v: Column, typ: str = "string", path: str = "$") -> Column:
    """Typed read of a variant value; ``NULL`` when absent or not castable."""
    return F.try_variant_get(v, path, typ)


def vnumber(v: Column, typ: str = "double") -> Column:
    """``vget`` of a number. JSON numbers are read from their text, as a variant of another
    numeric type is cast by an expression that Spark builds anew for every value."""
    return F.coalesce(F.to_json(v).try_cast(typ), vget(v, typ))


def vkind(v: Column) -> Column:
    """Variant type name: ``STRING``, ``BIGINT``, ``OBJECT<...>``, ``VOID``..."""
    return F.schema_of_variant(v)


def is_vnull(v: Column) -> Column:
    """True for an explicit JSON ``null`` (a missing key gives SQL NULL → False)."""
    return F.coalesce(F.is_variant_null(v), F.lit(False))


def is_vnumber(v: Column) -> Column:
    return F.coalesce(vkind(v).rlike(NUMERIC_VARIANT), F.lit(False))


def is_vstring(v: Column) -> Column:
    return F.coalesce(vkind(v) == F.lit("STRING"), F.lit(False))


def py_str(m: Column, key: str, default: str) -> Column:
    """``str(d.get(key, default))`` over a ``map<string,variant>``.

    Missing key → default; explicit null → ``'None'``; otherwise the value's text.
    """
    v = m[key]
    return (F.when(~F.map_contains_key(m, key) | m.isNull(), F.lit(default))
            .when(is_vnull(v), F.lit("None"))
            .when(vkind(v) == "BIGINT", F.to_json(v))
            .otherwise(vget(v, "string")))


# --- SC1 / SC2 / SC11 timestamps --------------------------------------------

def iso_timestamp(s: Column, fallback: Column) -> Column:
    """ISO-8601 text (naive = UTC, ``Z`` or offset) → TIMESTAMP; else ``fallback``.

    The prefix guard rejects what ``try_cast`` would accept but an ISO parser
    would not (bare times, bare years).
    """
    parsed = F.when(s.rlike(ISO_PREFIX), s.try_cast("timestamp"))
    return F.coalesce(parsed, fallback)


def nanos_timestamp(ns: Column, fallback: Column) -> Column:
    """OTLP epoch nanoseconds (text or number) → TIMESTAMP, exact to the µs."""
    n = F.trim(ns.cast("string")).try_cast("decimal(38,0)")
    micros = F.floor(n / F.lit(1000)).try_cast("bigint")
    return F.coalesce(F.timestamp_micros(micros), fallback)


def epoch_micros(ts: Column) -> Column:
    """SC11: microseconds since the epoch, the time form of published messages."""
    return F.unix_micros(ts)


# --- SC3 query fingerprint ----------------------------------------------------

def normalise_sql(q: Column) -> Column:
    """lower-case, collapse every whitespace run to one space, strip the ends."""
    return F.trim(F.regexp_replace(F.lower(q), PY_WHITESPACE, " "))


def query_fingerprint(q: Column) -> Column:
    """First 16 hex chars of SHA-256 of the normalised text."""
    return F.substring(F.sha2(normalise_sql(q), 256), 1, 16)


# --- SC4 key/value arrays → map ---------------------------------------------

def kv_map(arr: Column, keep_empty: bool = False, with_int: bool = False) -> Column:
    """OTLP ``[{key, value:{stringValue|string_value|intValue|int_value}}]`` → map.

    ``keep_empty``: keep keys whose value is missing as '' (log attributes);
    otherwise drop empty keys and empty values (resource / point attributes).
    ``with_int``: fall back to the integer value (resource attributes).
    """
    def val(x):
        s = F.coalesce(x["value"]["stringValue"], x["value"]["string_value"])
        if with_int:
            s = F.coalesce(F.nullif(s, F.lit("")),
                           F.coalesce(x["value"]["intValue"], x["value"]["int_value"]))
        return s

    if keep_empty:
        entries = F.transform(
            F.filter(F.coalesce(arr, F.array()), lambda x: x["key"].isNotNull()),
            lambda x: F.struct(x["key"].alias("key"),
                               F.coalesce(val(x), F.lit("")).alias("value")))
    else:
        entries = F.transform(
            F.filter(F.coalesce(arr, F.array()),
                     lambda x: (F.coalesce(x["key"], F.lit("")) != "")
                     & (F.coalesce(val(x), F.lit("")) != "")),
            lambda x: F.struct(x["key"].alias("key"), val(x).alias("value")))
    return F.map_from_entries(entries)


# --- SC5 numeric coercion ----------------------------------------------------

def to_number(s: Column) -> Column:
    """Text → DOUBLE like Python ``float()``: underscores ignored, no ``d``/``f`` suffix."""
    t = F.replace(F.trim(s), F.lit("_"), F.lit(""))
    ok = ~t.rlike(r"(?i)[df]$") | t.rlike(r"(?i)^[+-]?(inf|infinity|nan)$")
    return F.when(ok, t.try_cast("double"))


# --- SC10 row identity --------------------------------------------------------

def row_id(*parts: Column) -> Column:
    """Deterministic id: replaying the same message yields the same id."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


# --- SC12 syslog priority -----------------------------------------------------

def facility(pri: Column) -> Column:
    return F.floor(pri / 8).cast("int")


def severity(pri: Column) -> Column:
    return (pri % 8).cast("int")


def add_tag(tags: Column, cond: Column, key: str, value) -> Column:
    """``tags[key] = value`` when ``cond`` holds (later keys win)."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.when(F.coalesce(cond, F.lit(False)),
                  F.map_concat(tags, F.create_map(F.lit(key), v))).otherwise(tags)


def empty_str_map() -> Column:
    return F.create_map().cast("map<string,string>")


def empty_variant_map() -> Column:
    return F.create_map().cast("map<string,variant>")
