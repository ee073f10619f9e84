"""Schemas of flows, summaries and samples."""

from __future__ import annotations

FLOW_DDL = (
    "flow_id bigint, node_id int, foreign_source string, foreign_id string, if_index int, direction string, application string, "
    "location string, protocol int, src_address string, dst_address string, src_hostname string, dst_hostname string, dscp int, ecn int, "
    "delta_switched bigint, last_switched bigint, num_bytes bigint, sampling_interval double"
)
SUMMARY_DDL = (
    "`@timestamp` bigint, range_start bigint, range_end bigint, grouped_by string, aggregation_type string, bytes_ingress bigint, "
    "bytes_egress bigint, bytes_total bigint, dscp int, congestion_encountered boolean, non_ect boolean, "
    "exporter struct<foreign_source: string, foreign_id: string, node_id: int>, if_index int, application string, host_address string, "
    "host_name string, conversation_key string"
)
SERIES_DDL = "metric string, labels map<string, string>, ts_ms bigint, value double"

EXPORTER = ("node_id", "foreign_source", "foreign_id")
INTERFACE = (*EXPORTER, "if_index")
CONVERSATION = ("location", "protocol", "address", "larger_address", "application")
WINDOW = ("range_start", "range_end")
