"""Display keys, metric names, labels and index names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_APPLICATION = "__unknown"
#: JSON escapes of the display key, HTML-sensitive characters included.
ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f"),
           ("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026"), ("=", "\\u003d"), ("'", "\\u0027"))
#: Date patterns of the index strategies.
INDEX_PATTERNS = {"YEARLY": "yyyy", "MONTHLY": "yyyy-MM", "DAILY": "yyyy-MM-dd", "HOURLY": "yyyy-MM-dd-HH"}


def json_text(text: Column) -> Column:
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit('"'), text, F.lit('"'))


def conversation_key() -> Column:
    """[location,protocol,address,larger address,application] as JSON without spaces; a null protocol prints null."""
    protocol = F.coalesce(F.col("protocol").cast("string"), F.lit("null"))
    parts = [json_text(F.col("location")), protocol, *[json_text(F.col(c)) for c in ("address", "larger_address", "application")]]
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def exporter_key() -> Column:
    both = F.concat_ws(":", "foreign_source", "foreign_id")
    return F.when(F.col("foreign_source").isNotNull() & F.col("foreign_id").isNotNull(), both).otherwise(F.col("node_id").cast("string"))


def grouped_by_key(dims: tuple[str, ...]) -> Column:
    """The parts of a grouping's key in order, joined by dashes."""
    part = {
        "exporter": exporter_key(), "interface": F.col("if_index").cast("string"), "dscp": F.col("dscp").cast("string") if "dscp" in dims else None,
        "application": F.col("application"), "host": F.col("address"), "conversation": conversation_key() if "conversation" in dims else None,
    }
    return F.concat_ws("-", *[part[d] for d in dims])


def sanitize_label(name: Column) -> Column:
    return F.regexp_replace(name, "^[0-9]|[^a-zA-Z0-9_]", "_")


def sanitize_metric(name: Column) -> Column:
    return F.regexp_replace(name, "^[0-9]|[^a-zA-Z0-9_:]", "_")


def index_name(prefix: str, strategy: str, ts_ms: Column) -> Column:
    """prefix-date of the UTC time, whatever the session's time zone."""
    seconds = (ts_ms / F.lit(1000)).cast("decimal(18,6)")
    at = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.concat(F.lit(f"{prefix}-"), F.date_format(at, INDEX_PATTERNS[strategy]))
