"""The summary job as one logical plan: flows to summary documents, JSON and index names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import conversation_key, index_name
from ..operators.lattice import GROUPINGS, summarize_flows
from ..options import Options

TOTALS = [n for n, g in GROUPINGS.items() if g.total]


def summaries(flows: DataFrame, options: Options = Options(), names: tuple[str, ...] = tuple(GROUPINGS)) -> DataFrame:  # noqa: B008
    return summarize_flows(flows, options, names)


def documents(rows: DataFrame) -> DataFrame:
    """Summary rows as documents; the time stamp is the end of the range, host names stand on host rows only."""
    by = F.col("grouped_by")
    conversation, host = by.endswith("CONVERSATION"), by.endswith("HOST")
    return rows.select(
        F.col("range_end").alias("@timestamp"), "range_start", "range_end", "grouped_by",
        F.when(by.isin(TOTALS), F.lit("TOTAL")).otherwise(F.lit("TOPK")).alias("aggregation_type"),
        F.col("bytes_in").alias("bytes_ingress"), F.col("bytes_out").alias("bytes_egress"), (F.col("bytes_in") + F.col("bytes_out")).alias("bytes_total"),
        "dscp", F.col("congestion").alias("congestion_encountered"), "non_ect",
        F.struct("foreign_source", "foreign_id", "node_id").alias("exporter"), "if_index",
        "application", F.when(host, F.col("address")).alias("host_address"),
        F.when(host, F.nullif(F.col("hostname"), F.lit(""))).alias("host_name"),
        F.when(conversation, conversation_key()).alias("conversation_key"),
    )


def json_documents(docs: DataFrame, options: Options = Options()) -> DataFrame:  # noqa: B008
    """(index, document): absent fields are left out, except the exporter's, which print null."""
    exporter = F.to_json(F.col("exporter"), {"ignoreNullFields": "false"})
    rest = F.to_json(F.struct(*[c for c in docs.columns if c != "exporter"]))
    text = F.concat(F.expr("substring(__rest, 1, length(__rest) - 1)"), F.lit(',"exporter":'), exporter, F.lit("}"))
    name = index_name(options.elastic_index, options.elastic_index_strategy, F.col("range_end"))
    return docs.withColumn("__rest", rest).select(name.alias("index"), text.alias("document"))
