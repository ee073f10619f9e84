"""Flows of a simulator's reports: what exporters counted, dressed with protocols, applications and addresses."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .flows import normalized

EXPORTER_DDL = "node_id int, foreign_source string, foreign_id string, location string, input_snmp int, output_snmp int, clock_offset_ms bigint"
REPORT_DDL = "report_id bigint, node_id int, start_ms bigint, end_ms bigint, bytes bigint"
PROTOCOLS, APPLICATIONS, HOSTS = (6, 17), 200, 100


def exporters(spark: SparkSession, text: str) -> DataFrame:
    """The exporters of a simulation's JSON configuration; a missing clock offset is 0."""
    rows = [
        (int(e["nodeId"]), e["foreignSource"], e["foreignId"], e.get("location", ""), int(e["inputSnmp"]), int(e["outputSnmp"]), int(e.get("clockOffsetMs", 0)))
        for e in json.loads(text)["exporters"]
    ]
    return spark.createDataFrame(rows, EXPORTER_DDL)


def _letters(seed: int, kind: str, number: Column, length: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:{kind}:"), number.cast("string")), 256)
    return F.translate(F.substring(digest, 1, length), "0123456789abcdef", "abcdefghijklmnop")


def _address(seed: int, number: Column) -> Column:
    drawn = F.xxhash64(F.lit(seed), F.lit("address"), number)
    return F.concat_ws(".", *[F.pmod(F.shiftright(drawn, 8 * k), F.lit(256)).cast("string") for k in range(4)])


def flows_of_reports(reports: DataFrame, of: DataFrame, seed: int = 0) -> DataFrame:
    """One flow for each report (REPORT_DDL), of the exporter (EXPORTER_DDL) with its node id; others are dropped.

    The flow starts with the report and ends a millisecond before its end, both by the exporter's clock.  Protocol,
    application and the two hosts, each an address with its name, are drawn from pools by hashes of the seed and the
    report's id, so reruns and any split agree.
    """
    draw = lambda what, n: F.pmod(F.xxhash64(F.lit(seed), F.lit(what), "report_id"), F.lit(n))
    rows = reports.select("report_id", "node_id", "start_ms", "end_ms", "bytes").join(of, "node_id")
    rows = rows.withColumns({"__app": draw("application", APPLICATIONS), "__src": draw("source", HOSTS), "__dst": draw("destination", HOSTS)})
    raw = rows.select(
        F.col("report_id").alias("flow_id"), "node_id", "foreign_source", "foreign_id", F.lit("INGRESS").alias("direction"),
        F.col("input_snmp").alias("input_snmp_ifindex"), F.col("output_snmp").alias("output_snmp_ifindex"),
        _letters(seed, "application", F.col("__app"), 15).alias("application"), "location",
        F.when(draw("protocol", len(PROTOCOLS)) == 0, F.lit(PROTOCOLS[0])).otherwise(F.lit(PROTOCOLS[1])).alias("protocol"),
        _address(seed, F.col("__src")).alias("src_address"), _address(seed, F.col("__dst")).alias("dst_address"),
        _letters(seed, "host", F.col("__src"), 10).alias("src_hostname"), _letters(seed, "host", F.col("__dst"), 10).alias("dst_hostname"),
        F.lit(None).cast("int").alias("dscp"), F.lit(None).cast("int").alias("ecn"), (F.col("start_ms") + F.col("clock_offset_ms")).alias("delta_switched"),
        (F.col("end_ms") - 1 + F.col("clock_offset_ms")).alias("last_switched"), F.col("bytes").alias("num_bytes"), F.lit(None).cast("double").alias("sampling_interval"),
    )
    return normalized(raw)
