"""Flow sources: tables, file streams, Kafka, and flows derived from an event table."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FLOW_DDL

#: The fixture: each column's expression over ``events``, in SQL that both engines read; {str} is their text type.
FIXTURE = (
    ("flow_id", "event_id"),
    ("node_id", "CASE WHEN event_id % 101 = 100 THEN NULL ELSE CAST(user_id % 7 + 1 AS INT) END"),
    ("foreign_source", "CASE WHEN user_id % 3 = 0 THEN 'fs' ELSE '' END"),
    ("foreign_id", "CASE WHEN user_id % 3 = 0 THEN concat('fid', CAST(user_id % 7 AS {str})) ELSE NULL END"),
    ("if_index", "CAST(event_id % 3 + 1 AS INT)"),
    ("direction", "CASE WHEN event_id % 2 = 0 THEN 'INGRESS' ELSE 'EGRESS' END"),
    ("application", "CASE WHEN event_id % 13 = 0 THEN '' ELSE event_type END"),
    ("location", "CASE WHEN event_id % 8 = 0 THEN 'r&d' ELSE '' END"),
    ("protocol", "CAST(CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 4 = 0 THEN 17 ELSE 6 END AS INT)"),
    ("src_address", "concat('10.0.0.', CAST(user_id % 23 AS {str}))"),
    ("dst_address", "CASE WHEN event_id % 97 = 0 THEN '' ELSE concat('10.0.0.', CAST(event_id % 17 AS {str})) END"),
    ("src_hostname", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('host', CAST(user_id % 23 AS {str})) END"),
    ("dst_hostname", "CASE WHEN event_id % 4 = 0 THEN '' ELSE concat('host', CAST(event_id % 17 AS {str})) END"),
    ("dscp", "CAST(CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 4 END AS INT)"),
    ("ecn", "CAST(CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_id % 4 END AS INT)"),
    ("delta_switched", "{ms} - (event_id * 7919) % 1200000"),
    ("last_switched", "{ms}"),
    ("num_bytes", "CAST(round(value * 1000) AS BIGINT)"),
    ("sampling_interval", "CAST(CASE WHEN event_id % 6 = 0 THEN 10.0 WHEN event_id % 10 = 3 THEN 0.0 ELSE NULL END AS DOUBLE)"),
)
DENSE_MS = "(1704067200000 + event_id * 700)"
SPARK_MS = "(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ)) div 1000)"


def flows_from_events(events: DataFrame, dense: bool = True) -> DataFrame:
    """Deterministic flows of up to 20 minutes; ``dense`` spaces them 700 ms apart instead of by the events' own time."""
    ms = DENSE_MS if dense else SPARK_MS
    return events.selectExpr(*[f"{e.format(str='STRING', ms=ms)} AS {c}" for c, e in FIXTURE])


def normalized(raw: DataFrame) -> DataFrame:
    """Flows with their defaults: a missing start is that of the flow's first packet, missing numbers are 0, texts ''."""
    have = set(raw.columns)
    pick = lambda c, default: F.coalesce(F.col(c), default) if c in have else default
    start = pick("delta_switched", pick("first_switched", F.lit(0)))
    out = raw.withColumns({
        "delta_switched": start.cast("bigint"), "last_switched": pick("last_switched", F.lit(0)).cast("bigint"),
        "num_bytes": pick("num_bytes", F.lit(0)).cast("bigint"), "direction": pick("direction", F.lit("INGRESS")),
    })
    if {"input_snmp_ifindex", "output_snmp_ifindex"} <= have:
        out = out.withColumn("if_index", interface(F.col("direction"), F.col("input_snmp_ifindex"), F.col("output_snmp_ifindex")))
    texts = [c for c in ("application", "location", "src_address", "dst_address") if c in have]
    return out.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in texts})


def interface(direction: Column, incoming: Column, outgoing: Column) -> Column:
    return F.coalesce(F.when(direction == "INGRESS", incoming).otherwise(outgoing), F.lit(0)).cast("int")


def event_time(flows: DataFrame, *, cap_now: bool = True, column: str = "event_time") -> DataFrame:
    """Event time of a flow, its end; a clock ahead of now doesn't push a watermark beyond now."""
    at = F.timestamp_millis(F.col("last_switched"))
    return flows.withColumn(column, F.least(at, F.current_timestamp()) if cap_now else at)


def read_flows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return normalized(spark.read.schema(FLOW_DDL).format(fmt).load(path))


def stream_flows(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the files that appear in a folder; the file limit is the rate limit."""
    reader = spark.readStream.schema(FLOW_DDL).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return normalized(reader.load(path))


def client_properties(path: str) -> dict[str, str]:
    """Kafka client properties of a file as reader or writer options; a missing file is an error."""
    out = {}
    for line in Path(path).read_text().splitlines():
        line = line.strip()
        if line and line[0] not in "#!":
            name, _, value = line.partition("=")
            out[f"kafka.{name.strip()}"] = value.strip()
    return out


def kafka_options(bootstrap: str, topic: str, properties: dict[str, str] | None = None) -> dict[str, str]:
    """Options of the Kafka source; an explicit bootstrap overrides the properties."""
    return {**(properties or {}), "kafka.bootstrap.servers": bootstrap, "subscribe": topic}


def kafka_flows(spark: SparkSession, bootstrap: str, topic: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Flows from protobuf values of a topic (needs Spark's Kafka package)."""
    from .protobuf import decode_flows

    raw = spark.readStream.format("kafka").options(**kafka_options(bootstrap, topic, properties)).load()
    return normalized(decode_flows(raw.select("value")))
