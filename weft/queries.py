"""Queries of the flow operators over the data tables, and the same in SQL for another engine."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.ip import in_ranges, parse_host_filter
from .functions.names import conversation_key, grouped_by_key, index_name, sanitize_label, sanitize_metric
from .functions.windows import node_shift, window_number, window_start
from .operators.flows import conversation_rows, conversation_sums, dispatch, keyed, prorate, summed
from .operators.lattice import GROUPINGS, applications, complete, hosts, sums, top_k
from .options import Options
from .plans.series import considered, samples
from .plans.summaries import documents, json_documents, summaries
from .schema import CONVERSATION, INTERFACE, WINDOW
from .sources.flows import DENSE_MS, FIXTURE, event_time, flows_from_events, normalized
from .sources.simulated import exporters, flows_of_reports
from .sources.synthetic import FlowConfig, clock_skew, synthetic_flows

OPTIONS = Options(top_k=2, remote_write_hosts="10.0.0.3-10.0.0.7, 10.0.0.16/30, 10.0.0.1")
SKEWED = FlowConfig(skew_ms=40_000, skew_groups=3, exporters=7)
Query = Callable[[SparkSession, str], DataFrame]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def flows(spark: SparkSession, sf_dir: str, dense: bool = True) -> DataFrame:
    return flows_from_events(events(spark, sf_dir), dense)


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_sums(flows(spark, sf_dir), OPTIONS)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_rows(flows(spark, sf_dir), OPTIONS)


def _grouped(name: str, pruned: bool) -> Query:
    g = GROUPINGS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = sums(_rows(spark, sf_dir))[name]
        if pruned:
            rows = top_k(complete(rows) if name.endswith("CONVERSATION") else rows, g, OPTIONS.top_k)
        else:
            rows = rows.withColumn("grouped_by_key", grouped_by_key(g.dims))
        return rows.select(*WINDOW, *g.keys, "grouped_by_key", "bytes_in", "bytes_out", "hostname", "congestion", "non_ect")

    return run


def shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window shifts of nodes at two sizes."""
    nodes = events(spark, sf_dir).select(F.col("user_id").cast("int").alias("node_id")).distinct()
    return nodes.select("node_id", node_shift(F.col("node_id"), 60_000).alias("shift_60s"), node_shift(F.col("node_id"), 10_000).alias("shift_10s"))


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and start of the window that holds a flow's end."""
    s = node_shift(F.col("node_id"), 60_000)
    return flows(spark, sf_dir).select(
        "flow_id", window_number(F.col("last_switched"), s, 60_000).alias("number"), window_start(F.col("last_switched"), s, 60_000).alias("start")
    )


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_time(flows(spark, sf_dir, dense=False), cap_now=False)
    return rows.select("flow_id", F.unix_millis("event_time").alias("event_ms"))


def normalized_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing starts patched from the first packet, the interface chosen by direction."""
    raw = flows(spark, sf_dir).select(
        "flow_id", "direction", F.when(F.col("flow_id") % 3 != 0, F.col("delta_switched")).alias("delta_switched"),
        (F.col("delta_switched") - 5).alias("first_switched"), "last_switched", "num_bytes",
        F.when(F.col("flow_id") % 4 != 0, F.col("if_index")).alias("input_snmp_ifindex"), (F.col("if_index") + 10).alias("output_snmp_ifindex"),
    )
    return normalized(raw).select("flow_id", "delta_switched", "if_index")


def dispatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch(flows(spark, sf_dir, dense=False), OPTIONS).select("flow_id", "node_id", *WINDOW)


def prorated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prorate(dispatch(flows(spark, sf_dir, dense=False), OPTIONS)).select("flow_id", *WINDOW, "bytes")


def keyed_conv_tos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(prorate(dispatch(flows(spark, sf_dir), OPTIONS)))


def conv_tos_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conversations(spark, sf_dir)


def itf_total_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interface totals on the events' own clock."""
    rows = sums(conversation_rows(flows(spark, sf_dir, dense=False), OPTIONS))["EXPORTER_INTERFACE"]
    return rows.select(*WINDOW, *INTERFACE, "bytes_in", "bytes_out")


def all_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight groupings of the flows."""
    return summaries(flows(spark, sf_dir), OPTIONS)


def flow_summary_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(all_summaries(spark, sf_dir))
    return rows.select(
        "`@timestamp`", "range_start", "range_end", "grouped_by", "aggregation_type", "bytes_ingress", "bytes_egress", "bytes_total", "dscp",
        "congestion_encountered", "non_ect", F.col("exporter.foreign_source").alias("foreign_source"), F.col("exporter.foreign_id").alias("foreign_id"),
        F.col("exporter.node_id").alias("node_id"), "if_index", "application", "host_address", "host_name", "conversation_key",
    ).withColumnRenamed("@timestamp", "at_timestamp")


def summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index and JSON text of the documents of all groupings."""
    return json_documents(documents(all_summaries(spark, sf_dir)), OPTIONS)


def index_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("last_switched")
    return flows(spark, sf_dir, dense=False).select(
        "flow_id", *[index_name("netflow_agg", k, at).alias(k.lower()) for k in ("YEARLY", "MONTHLY", "DAILY", "HOURLY")]
    )


def _labels_text() -> Column:
    pairs = F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(pairs, ",")


def series_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(all_summaries(spark, sf_dir))
    return rows.select("metric", _labels_text().alias("labels"), "ts_ms", "value")


def series_filtered_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = tuple(n for n in GROUPINGS if not n.endswith("CONVERSATION"))  # no sample shows conversations
    rows = samples(considered(summaries(flows(spark, sf_dir), OPTIONS, names), OPTIONS))
    return rows.select("metric", _labels_text().alias("labels"), "ts_ms", "value")


def hosts_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = parse_host_filter(OPTIONS.remote_write_hosts)
    address = flows(spark, sf_dir).select(F.col("dst_address").alias("address")).distinct()
    return address.select("address", in_ranges(F.col("address"), ranges).alias("inside"))


def sanitized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("event_id").cast("string"), F.lit("a:b-c."), F.col("event_type"))
    return events(spark, sf_dir).select("event_id", sanitize_label(name).alias("label"), sanitize_metric(name).alias("metric"))


def conversation_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conversations(spark, sf_dir).select(*CONVERSATION, conversation_key().alias("conversation_key")).distinct()


def complete_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = complete(sums(_rows(spark, sf_dir))["EXPORTER_INTERFACE_CONVERSATION"])
    return rows.groupBy(*INTERFACE).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bytes_in") + F.col("bytes_out")).alias("bytes_total"))


def missing_fields_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in windows without an exporter, which keying drops."""
    return dispatch(flows(spark, sf_dir), OPTIONS).agg(F.count_if(F.col("node_id").isNull()).alias("missing"), F.count(F.lit(1)).alias("in_window"))


def too_old_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of each flow with the limit on its length, and without."""
    n = F.count(F.lit(1))
    limited = dispatch(flows(spark, sf_dir), OPTIONS).groupBy("flow_id").agg(n.alias("kept"))
    unlimited = dispatch(flows(spark, sf_dir), Options(max_flow_ms=10_000_000)).groupBy("flow_id").agg(n.alias("windows"))
    return unlimited.join(limited, "flow_id", "left").where("windows > kept")


def volume_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of all windows of each flow: its total, less what lies before the first window within the length limit."""
    return prorate(dispatch(flows(spark, sf_dir), OPTIONS)).groupBy("flow_id").agg(F.sum("bytes").alias("bytes"))


def window_top_talkers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top hosts a window over all exporters, on the sums alone."""
    rows = summed(hosts(_conversations(spark, sf_dir)), ("address",))
    order = Window.orderBy(F.desc(F.col("bytes_in") + F.col("bytes_out")), "address")
    return rows.withColumn("rank", F.row_number().over(order)).where("rank <= 10").select("rank", "address", "bytes_in", "bytes_out")


def application_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = applications(_conversations(spark, sf_dir))
    return rows.groupBy("application").agg(F.sum("bytes_in").alias("bytes_in"), F.sum("bytes_out").alias("bytes_out"), F.count("hostname").alias("named"))


def synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of synthetic flows by node and direction; as many flows as there are events."""
    n = events(spark, sf_dir).count()
    return synthetic_flows(spark, n).groupBy("node_id", "direction").agg(F.count(F.lit(1)).alias("flows"), F.sum("num_bytes").alias("bytes"))


def simulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows of simulated reports, one an event, by exporters of which one has a clock of its own."""
    text = json.dumps({"exporters": [
        {"nodeId": n, "foreignSource": "fs", "foreignId": f"fid{n}", "location": "l", "inputSnmp": 10 + n, "outputSnmp": 20 + n, "clockOffsetMs": 500 if n == 2 else 0}
        for n in (1, 2, 3)
    ]})
    reports = events(spark, sf_dir).selectExpr(
        "event_id AS report_id", "CAST(user_id % 4 + 1 AS INT) AS node_id", "1704067200000 + event_id * 700 AS start_ms",
        "1704067200000 + event_id * 700 + user_id AS end_ms", "CAST(round(value * 1000) AS BIGINT) AS bytes",
    )
    found = flows_of_reports(reports, exporters(spark, text))
    return found.select(
        "flow_id", "node_id", "foreign_id", "if_index", "delta_switched", "last_switched", "num_bytes", F.col("protocol").isin(6, 17).alias("known_protocol"),
        F.length("application").alias("application_length"),
    )


def clock_skews(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = events(spark, sf_dir).select((F.col("user_id") % 7 + 1).cast("int").alias("node_id")).distinct()
    return nodes.select("node_id", clock_skew(F.col("node_id"), SKEWED).alias("skew_ms"))


def sample_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes that keep the times of a user's events rising, in the order of their ids."""
    from .streaming.state import indexed

    rows = events(spark, sf_dir).select("user_id", F.col("event_id").alias("arrival"), (F.col("event_id") * 7919 % 50).alias("ts_ms"))
    return indexed(rows, ["user_id"])


def _shared_folder(spark: SparkSession, name: str) -> str:
    """A folder that all executors see: in the checkpoint folder, or a temporary one with a local master."""
    import tempfile

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="weft-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _streamed(spark: SparkSession, sf_dir: str, final: bool) -> DataFrame:
    from .sources.flows import stream_flows
    from .sources.synthetic import ingest
    from .streaming.modes import run_final, run_panes

    folder = _shared_folder(spark, "stream")
    # every partition of a stateful query keeps a store of its own, so this small stream gets few
    session = spark.newSession()
    partitions = min(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    source = flows(session, sf_dir)
    ingest(source, f"{folder}/in", 4)
    if final:  # a flow far in the future completes every window before it
        late = source.orderBy(F.desc("last_switched")).limit(1)
        late = late.withColumns({"node_id": F.lit(-1), "delta_switched": F.lit(4_000_000_000_000), "last_switched": F.lit(4_000_000_000_000)})
        for _ in range(2):
            late.coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.where("grouped_by = 'EXPORTER_INTERFACE' AND node_id > 0").write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    stream = stream_flows(session, f"{folder}/in", files_per_trigger=1)
    query = run_final(stream, sink, OPTIONS, names=("EXPORTER_INTERFACE",)) if final else run_panes(stream, sink, OPTIONS)
    query.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy(*WINDOW, *INTERFACE).agg(F.sum("bytes_in").alias("bytes_in"), F.sum("bytes_out").alias("bytes_out"))


def stream_final_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interface totals of a stream of files, each window reported once by the watermark."""
    return _streamed(spark, sf_dir, final=True)


def stream_panes_resummed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interface totals of a stream of files, added up over micro-batch panes."""
    return _streamed(spark, sf_dir, final=False)


def pane_accumulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interface totals of a stream in panes that keyed state merges before they are written."""
    from .job import KEYS, ROCKS, hand_over, handed, handed_rows
    from .sources.flows import stream_flows
    from .sources.synthetic import ingest
    from .streaming.modes import drain, run_panes
    from .streaming.state import accumulate

    folder = _shared_folder(spark, "accumulated")
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(min(16, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    ingest(flows(session, sf_dir), f"{folder}/in", 4)
    keep = hand_over(f"{folder}/panes")

    def totals(batch: DataFrame, batch_id: int) -> None:
        keep(batch.where("grouped_by = 'EXPORTER_INTERFACE'").drop("pane"), batch_id)

    panes = run_panes(stream_flows(session, f"{folder}/in", files_per_trigger=1), totals, OPTIONS)
    panes.option("checkpointLocation", f"{folder}/state/panes").trigger(availableNow=True).start().awaitTermination()
    # windows that ended long ago are merged for the delay alone
    merged = accumulate(handed(session, f"{folder}/panes"), KEYS, 2_000, OPTIONS.allowed_lateness_ms)
    query = merged.writeStream.foreachBatch(hand_over(f"{folder}/out")).option("checkpointLocation", f"{folder}/state/merged")
    query = query.trigger(processingTime="500 milliseconds").start()
    drain(query)
    return handed_rows(spark, f"{folder}/out").select(*WINDOW, *INTERFACE, "bytes_in", "bytes_out")


def _named() -> dict[str, Query]:
    short = {
        "EXPORTER_INTERFACE": "itf_total", "EXPORTER_INTERFACE_TOS": "tos_total", "EXPORTER_INTERFACE_APPLICATION": "app", "EXPORTER_INTERFACE_HOST": "host",
        "EXPORTER_INTERFACE_CONVERSATION": "conv", "EXPORTER_INTERFACE_TOS_APPLICATION": "app_tos", "EXPORTER_INTERFACE_TOS_HOST": "host_tos",
        "EXPORTER_INTERFACE_TOS_CONVERSATION": "conv_tos",
    }
    out = {}
    for name, s in short.items():
        if GROUPINGS[name].total:
            out[s] = _grouped(name, False)
        else:
            out |= {f"topk_{s}": _grouped(name, True)} | ({f"{s}_sum": _grouped(name, False)} if s != "conv_tos" else {})
    return out


QUERIES: dict[str, Query] = {
    "all_summaries": all_summaries, "flows": lambda s, d: flows(s, d, dense=False), "normalized_flows": normalized_flows, "event_times": event_times,
    "shift": shift, "windows": windows, "dispatch": dispatched, "prorate": prorated, "keyed_conv_tos": keyed_conv_tos, "conv_tos_sum": conv_tos_sum,
    **_named(), "itf_total_sparse": itf_total_sparse, "flow_summary_docs": flow_summary_docs, "summary_json": summary_json, "index_names": index_names,
    "series_samples": series_samples, "series_filtered_hosts": series_filtered_hosts, "hosts_in_ranges": hosts_in_ranges,
    "sanitized_names": sanitized_names, "conversation_keys": conversation_keys, "complete_conversations": complete_conversations,
    "missing_fields_count": missing_fields_count, "too_old_dropped": too_old_dropped, "volume_conservation": volume_conservation,
    "window_top_talkers": window_top_talkers, "application_rows": application_rows, "synthetic_flows": synthetic, "clock_skew": clock_skews, "simulated_flows": simulated,
    "sample_index": sample_index, "stream_final_totals": stream_final_totals, "stream_panes_resummed": stream_panes_resummed,
    "pane_accumulated": pane_accumulated,
}

# --- the same in SQL -------------------------------------------------------------------------------------------------

_RAW_MS = "(epoch_us(ts) // 1000)"
_SHIFT = "abs(CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END) % {w}"


def _shift_sql(node: str, w: int) -> str:
    h = f"((coalesce({node}, 0)::BIGINT * -1640531527) & 4294967295)"
    return _SHIFT.format(h=f"xor({h}, {h} >> 16)", w=w)


def _base(dense: bool = True, where: str = "true", max_flow: int = 900_000, source: str = "events") -> str:
    ms = DENSE_MS if dense else _RAW_MS
    columns = ", ".join(f"{e.format(str='VARCHAR', ms=ms)} AS {c}" for c, e in FIXTURE)
    return f"""WITH flows AS (SELECT {columns} FROM {source}),
shifted AS (SELECT *, {_shift_sql('node_id', 60000)} AS shift FROM flows WHERE {where}),
numbered AS (SELECT *, (delta_switched - shift) // 60000 AS w0, unnest(range((delta_switched - shift) // 60000, (last_switched - shift) // 60000 + 1)) AS wn
  FROM shifted WHERE delta_switched >= shift),
dispatched AS (SELECT *, shift + wn * 60000 AS range_start, shift + wn * 60000 + 60000 AS range_end FROM numbered
  WHERE least(delta_switched + (wn - w0) * 60000, last_switched) > last_switched - {max_flow}),
volumes AS (SELECT *, CASE WHEN sampling_interval > 0 THEN num_bytes * sampling_interval ELSE CAST(num_bytes AS DOUBLE) END AS mb,
  CAST(last_switched - delta_switched + 1 AS DOUBLE) AS dur FROM dispatched),
prorated AS (SELECT *, CAST(trunc((least(last_switched, range_end - 1) - delta_switched + 1) * mb / dur) AS BIGINT)
  - CAST(trunc((greatest(delta_switched, range_start) - delta_switched) * mb / dur) AS BIGINT) AS bytes FROM volumes),
keyed AS (SELECT range_start, range_end, node_id, CASE WHEN foreign_source <> '' AND foreign_id <> '' THEN foreign_source END AS foreign_source,
  CASE WHEN foreign_source <> '' AND foreign_id <> '' THEN foreign_id END AS foreign_id, if_index, coalesce(dscp, 0) AS dscp, location, protocol,
  CASE WHEN src_address < dst_address THEN src_address ELSE dst_address END AS address,
  CASE WHEN src_address < dst_address THEN dst_address ELSE src_address END AS larger_address,
  CASE WHEN application = '' THEN '__unknown' ELSE application END AS application,
  CASE WHEN direction = 'INGRESS' THEN bytes ELSE 0 END AS bytes_in, CASE WHEN direction = 'INGRESS' THEN 0 ELSE bytes END AS bytes_out,
  CASE WHEN src_address < dst_address THEN src_hostname ELSE dst_hostname END AS hostname,
  CASE WHEN src_address < dst_address THEN dst_hostname ELSE src_hostname END AS hostname2,
  coalesce(ecn = 3, false) AS congestion, coalesce(ecn, 0) = 0 AS non_ect FROM prorated WHERE node_id IS NOT NULL),
conv_tos AS (SELECT range_start, range_end, node_id, foreign_source, foreign_id, if_index, dscp, location, protocol, address, larger_address, application,
  {_VALUES}, min(nullif(hostname2, '')) AS hostname2 FROM keyed GROUP BY ALL)"""


_VALUES = (
    "CAST(sum(bytes_in) AS BIGINT) AS bytes_in, CAST(sum(bytes_out) AS BIGINT) AS bytes_out, min(nullif(hostname, '')) AS hostname, "
    "bool_or(congestion) AS congestion, bool_or(non_ect) AS non_ect"
)
_EXPORTER_SQL = "CASE WHEN foreign_source IS NOT NULL AND foreign_id IS NOT NULL THEN foreign_source || ':' || foreign_id ELSE CAST(node_id AS VARCHAR) END"


def _quoted(c: str) -> str:
    return f"'\"' || replace({c}, '&', '\\u0026') || '\"'"


_CONVERSATION_SQL = (
    f"'[' || {_quoted('location')} || ',' || coalesce(CAST(protocol AS VARCHAR), 'null') || ',' || {_quoted('address')} || ',' || "
    f"{_quoted('larger_address')} || ',' || {_quoted('application')} || ']'"
)
_PARTS_SQL = {
    "exporter": _EXPORTER_SQL, "interface": "CAST(if_index AS VARCHAR)", "dscp": "CAST(dscp AS VARCHAR)", "application": "application", "host": "address",
    "conversation": _CONVERSATION_SQL,
}
_HOSTS_SQL = (
    "(SELECT range_start, range_end, node_id, foreign_source, foreign_id, if_index, dscp, address, hostname, bytes_in, bytes_out, congestion, non_ect FROM conv_tos "
    "UNION ALL SELECT range_start, range_end, node_id, foreign_source, foreign_id, if_index, dscp, larger_address, hostname2, bytes_in, bytes_out, congestion, "
    "non_ect FROM conv_tos)"
)


def _grouping_sql(name: str, pruned: bool) -> str:
    """Sums or top k of a grouping straight from the finest sums."""
    g = GROUPINGS[name]
    keys, source = ", ".join((*WINDOW, *g.keys)), "conv_tos"
    if "host" in g.dims:
        source = _HOSTS_SQL
    else:
        source = "(SELECT * REPLACE (CAST(NULL AS VARCHAR) AS hostname) FROM conv_tos)"
    key = " || '-' || ".join(f"({_PARTS_SQL[d]})" for d in g.dims)
    rows = f"SELECT {keys}, {key} AS grouped_by_key, {_VALUES} FROM {source} GROUP BY {keys}"
    if not pruned:
        return rows
    if "conversation" in g.dims:
        rows = f"SELECT * FROM ({rows}) WHERE protocol IS NOT NULL AND address <> '' AND larger_address <> ''"
    parent = ", ".join((*WINDOW, *g.parent))
    ranked = f"SELECT *, row_number() OVER (PARTITION BY {parent} ORDER BY bytes_in + bytes_out DESC, grouped_by_key) AS rk FROM ({rows})"
    return f"SELECT * EXCLUDE (rk) FROM ({ranked}) WHERE rk <= {OPTIONS.top_k}"


def _all_sql() -> str:
    parts = []
    for name, g in GROUPINGS.items():
        kinds = {"dscp": "INTEGER", "protocol": "INTEGER"}
        has = set(g.keys)
        columns = ", ".join(c if c in has else f"CAST(NULL AS {kinds.get(c, 'VARCHAR')}) AS {c}" for c in (*INTERFACE, "dscp", *CONVERSATION))
        rows = _grouping_sql(name, not g.total)
        parts.append(
            f"SELECT range_start, range_end, '{name}' AS grouped_by, {columns}, bytes_in, bytes_out, hostname, CAST(NULL AS VARCHAR) AS hostname2, congestion, non_ect, grouped_by_key FROM ({rows})"
        )
    return " UNION ALL ".join(parts)


_TOTAL_SQL = "grouped_by IN ('EXPORTER_INTERFACE', 'EXPORTER_INTERFACE_TOS')"
_SERIES_SQL = f"""SELECT CASE WHEN {_TOTAL_SQL} THEN grouped_by ELSE 'BY_' || CASE WHEN grouped_by LIKE '%TOS%' THEN 'TOS_AND_' ELSE '' END ||
  CASE WHEN grouped_by LIKE '%APPLICATION' THEN 'APP' WHEN grouped_by LIKE '%HOST' THEN 'HOST' ELSE 'CONV' END || '_' || node_id || '_' || if_index END AS metric,
  concat_ws(',', CASE WHEN grouped_by LIKE '%APPLICATION' OR grouped_by LIKE '%CONVERSATION' THEN 'application=' || application END, 'direction=' || direction,
  CASE WHEN grouped_by LIKE '%TOS%' THEN 'dscp=' || dscp END, CASE WHEN grouped_by LIKE '%HOST' OR grouped_by LIKE '%CONVERSATION' THEN 'host=' || address END,
  CASE WHEN grouped_by LIKE '%CONVERSATION' THEN 'host2=' || larger_address END, CASE WHEN {_TOTAL_SQL} THEN 'ifIndex=' || if_index END,
  CASE WHEN grouped_by LIKE '%CONVERSATION' THEN 'location=' || location END, CASE WHEN {_TOTAL_SQL} THEN 'nodeId=' || node_id END, 'pane=0',
  CASE WHEN grouped_by LIKE '%CONVERSATION' THEN 'protocol=' || protocol END) AS labels, range_end - 1 AS ts_ms, CAST(value AS DOUBLE) AS value
FROM (SELECT *, 'in' AS direction, bytes_in AS value FROM summaries UNION ALL SELECT *, 'out', bytes_out FROM summaries)"""
_INSIDE_SQL = "coalesce(try_cast(nullif(split_part({a}, '.', 4), '') AS INTEGER) IN (1, 3, 4, 5, 6, 7, 16, 17, 18, 19), false)"


def _synthetic_sql() -> str:
    """Synthetic flows by the published 64-bit xxHash of two ints and a long, in steps of unsigned arithmetic."""
    p1, p2, p3, p4, p5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
    wide = lambda x: f"CAST(({x}) % 18446744073709551616::UHUGEINT AS UBIGINT)"
    times = lambda x, p: wide(f"({x})::UHUGEINT * {p}::UHUGEINT")
    plus = lambda x, p: wide(f"({x})::UHUGEINT + {p}::UHUGEINT")
    turned = lambda x, n: wide(f"({x})::UHUGEINT * {2**n}::UHUGEINT + ({x}) // {2 ** (64 - n)}::UBIGINT")
    mixed = lambda x, n: f"xor({x}, {x} // {2**n}::UBIGINT)"
    steps: list[str] = []

    def hashed(value: str, size: int) -> None:
        if size == 4:
            body = [plus("h", p5 + 4), f"xor(h, {times(value, p1)})", turned("h", 23), plus(times("h", p2), p3)]
        else:
            body = [plus("h", p5 + 8), f"xor(h, {times(turned(times(value, p2), 31), p1)})", turned("h", 27), plus(times("h", p1), p4)]
        steps.extend([*body, times(mixed("h", 33), p2), times(mixed("h", 29), p3), mixed("h", 32)])

    hashed("1", 4)
    hashed("salt", 4)
    hashed("idx", 8)
    ctes = ["h0 AS (SELECT idx, salt, 42::UBIGINT AS h FROM (SELECT unnest(range(n)) AS idx FROM (SELECT count(*) AS n FROM events)), (SELECT unnest([1, 4, 5, 6, 12, 13]) AS salt))"]
    ctes += [f"h{k + 1} AS (SELECT idx, salt, {step} AS h FROM h{k})" for k, step in enumerate(steps)]
    signed = "CASE WHEN h >= 9223372036854775808::UBIGINT THEN h::HUGEINT - 18446744073709551616 ELSE h::HUGEINT END"
    pick = lambda salt, n: f"max(CASE WHEN salt = {salt} THEN ((v % {n}) + {n}) % {n} END)"
    return f"""WITH {", ".join(ctes)}, signed AS (SELECT idx, salt, {signed} AS v FROM h{len(steps)}),
picked AS (SELECT idx, {pick(1, 5)} + 1 AS node, {pick(4, 10)} + {pick(5, 5)} + {pick(6, 5)} AS far, {pick(12, 1 << 20)} AS size, {pick(13, 2)} AS outward FROM signed GROUP BY idx)
SELECT CAST(node AS INTEGER) AS node_id, CASE WHEN outward = 0 THEN 'INGRESS' ELSE 'EGRESS' END AS direction, count(*) AS flows,
 CAST(sum(CAST(floor(size::DOUBLE * (exp(-0.5::DOUBLE * far::DOUBLE) * 0.5::DOUBLE)) AS BIGINT)) AS BIGINT) AS bytes FROM picked GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    dense, sparse = _base(), _base(dense=False)
    summaries_cte = f"{dense},\nsummaries AS ({_all_sql()})"
    total = "CASE WHEN grouped_by IN ('EXPORTER_INTERFACE', 'EXPORTER_INTERFACE_TOS') THEN 'TOTAL' ELSE 'TOPK' END"
    itf = f"{dense} SELECT range_start, range_end, node_id, foreign_source, foreign_id, if_index, CAST(sum(bytes_in) AS BIGINT) AS bytes_in, CAST(sum(bytes_out) AS BIGINT) AS bytes_out FROM conv_tos GROUP BY ALL"
    s60 = _shift_sql("node_id", 60000)
    flows_only = dense.split(",\nshifted AS", 1)[0]
    sparse_only = sparse.split(",\nshifted AS", 1)[0]
    out = {
        "all_summaries": f"{summaries_cte} SELECT * FROM summaries",
        "flows": f"{sparse_only} SELECT * FROM flows",
        "normalized_flows": f"{flows_only} SELECT flow_id, CASE WHEN flow_id % 3 <> 0 THEN delta_switched ELSE delta_switched - 5 END AS delta_switched, CAST(CASE WHEN direction = 'INGRESS' THEN CASE WHEN flow_id % 4 <> 0 THEN if_index ELSE 0 END ELSE if_index + 10 END AS INTEGER) AS if_index FROM flows",
        "event_times": f"{sparse_only} SELECT flow_id, last_switched AS event_ms FROM flows",
        "shift": f"SELECT DISTINCT CAST(user_id AS INTEGER) AS node_id, {_shift_sql('user_id', 60000)} AS shift_60s, {_shift_sql('user_id', 10000)} AS shift_10s FROM events",
        "windows": f"{flows_only} SELECT flow_id, (last_switched - {s60}) // 60000 AS number, {s60} + ((last_switched - {s60}) // 60000) * 60000 AS start FROM flows",
        "dispatch": f"{sparse} SELECT flow_id, node_id, range_start, range_end FROM dispatched",
        "prorate": f"{sparse} SELECT flow_id, range_start, range_end, bytes FROM prorated",
        "keyed_conv_tos": f"{dense} SELECT * FROM keyed",
        "conv_tos_sum": f"{dense} SELECT * FROM conv_tos",
        "itf_total_sparse": itf.replace(dense, sparse),
        "flow_summary_docs": f"""{summaries_cte} SELECT range_end AS at_timestamp, range_start, range_end, grouped_by, {total} AS aggregation_type, bytes_in AS bytes_ingress,
 bytes_out AS bytes_egress, bytes_in + bytes_out AS bytes_total, dscp, congestion AS congestion_encountered, non_ect, foreign_source, foreign_id, node_id, if_index,
 application, CASE WHEN grouped_by LIKE '%HOST' THEN address END AS host_address, CASE WHEN grouped_by LIKE '%HOST' THEN nullif(hostname, '') END AS host_name,
 CASE WHEN grouped_by LIKE '%CONVERSATION' THEN {_CONVERSATION_SQL} END AS conversation_key FROM summaries""",
        "summary_json": f"""{summaries_cte}, docs AS (SELECT *, {total} AS aggregation_type, CASE WHEN grouped_by LIKE '%HOST' THEN address END AS host_address,
 CASE WHEN grouped_by LIKE '%HOST' THEN nullif(hostname, '') END AS host_name, CASE WHEN grouped_by LIKE '%CONVERSATION' THEN {_CONVERSATION_SQL} END AS conversation_key FROM summaries)
SELECT 'netflow_agg-' || strftime(make_timestamp(range_end * 1000), '%Y-%m') AS index,
 '{{"@timestamp":' || range_end || ',"range_start":' || range_start || ',"range_end":' || range_end || ',"grouped_by":"' || grouped_by || '","aggregation_type":"' || aggregation_type || '","bytes_ingress":' || bytes_in ||
 ',"bytes_egress":' || bytes_out || ',"bytes_total":' || (bytes_in + bytes_out) || coalesce(',"dscp":' || dscp, '') || ',"congestion_encountered":' || congestion || ',"non_ect":' || non_ect ||
 ',"if_index":' || if_index || coalesce(',"application":' || to_json(application), '') || coalesce(',"host_address":' || to_json(host_address), '') ||
 coalesce(',"host_name":' || to_json(host_name), '') || coalesce(',"conversation_key":' || to_json(conversation_key), '') ||
 ',"exporter":{{"foreign_source":' || coalesce('"' || foreign_source || '"', 'null') || ',"foreign_id":' || coalesce('"' || foreign_id || '"', 'null') ||
 ',"node_id":' || node_id || '}}}}' AS document FROM docs""",
        "index_names": f"{sparse_only} SELECT flow_id, " + ", ".join(f"'netflow_agg-' || strftime(make_timestamp(last_switched * 1000), '{p}') AS {n}" for n, p in (("yearly", "%Y"), ("monthly", "%Y-%m"), ("daily", "%Y-%m-%d"), ("hourly", "%Y-%m-%d-%H"))) + " FROM flows",
        "series_samples": f"{summaries_cte} {_SERIES_SQL}",
        "series_filtered_hosts": f"{dense},\neverything AS ({_all_sql()}), summaries AS (SELECT * FROM everything WHERE grouped_by NOT LIKE '%CONVERSATION' AND (grouped_by NOT LIKE '%HOST' OR {_INSIDE_SQL.format(a='address')})) {_SERIES_SQL}",
        "hosts_in_ranges": f"{flows_only} SELECT DISTINCT dst_address AS address, {_INSIDE_SQL.format(a='dst_address')} AS inside FROM flows",
        "sanitized_names": "SELECT event_id, regexp_replace(n, '^[0-9]|[^a-zA-Z0-9_]', '_', 'g') AS label, regexp_replace(n, '^[0-9]|[^a-zA-Z0-9_:]', '_', 'g') AS metric FROM (SELECT event_id, event_id || 'a:b-c.' || event_type AS n FROM events)",
        "conversation_keys": f"{dense} SELECT DISTINCT location, protocol, address, larger_address, application, {_CONVERSATION_SQL} AS conversation_key FROM conv_tos",
        "complete_conversations": f"{dense}, c AS ({_grouping_sql('EXPORTER_INTERFACE_CONVERSATION', False)}) SELECT node_id, foreign_source, foreign_id, if_index, count(*) AS n, CAST(sum(bytes_in + bytes_out) AS BIGINT) AS bytes_total FROM c WHERE protocol IS NOT NULL AND address <> '' AND larger_address <> '' GROUP BY ALL",
        "missing_fields_count": f"{dense} SELECT count(*) FILTER (WHERE node_id IS NULL) AS missing, count(*) AS in_window FROM dispatched",
        "too_old_dropped": f"{_base(max_flow=10_000_000)} SELECT flow_id, count(*) AS windows, count(*) FILTER (WHERE least(delta_switched + (wn - w0) * 60000, last_switched) > last_switched - 900000) AS kept FROM dispatched GROUP BY flow_id HAVING windows > kept",
        "volume_conservation": f"""{flows_only}, placed AS (SELECT flow_id, delta_switched AS t0, last_switched AS t1, {s60} AS shift,
  CASE WHEN sampling_interval > 0 THEN num_bytes * sampling_interval ELSE CAST(num_bytes AS DOUBLE) END AS mb,
  CASE WHEN t1 - 900000 < t0 THEN 0 ELSE (t1 - 900000 - t0) // 60000 + 1 END AS skipped FROM flows),
cut AS (SELECT *, greatest(t0, shift + 60000 * least((t0 - shift) // 60000 + skipped, (t1 - shift) // 60000)) - t0 AS before FROM placed)
SELECT flow_id, CAST(trunc(mb) AS BIGINT) - CAST(trunc(before * mb / CAST(t1 - t0 + 1 AS DOUBLE)) AS BIGINT) AS bytes FROM cut""",
        "window_top_talkers": f"{dense}, h AS (SELECT address, CAST(sum(bytes_in) AS BIGINT) AS bytes_in, CAST(sum(bytes_out) AS BIGINT) AS bytes_out FROM {_HOSTS_SQL} GROUP BY address) SELECT CAST(row_number() OVER (ORDER BY bytes_in + bytes_out DESC, address) AS INTEGER) AS rank, * FROM h QUALIFY rank <= 10",
        "application_rows": f"{dense} SELECT application, CAST(sum(bytes_in) AS BIGINT) AS bytes_in, CAST(sum(bytes_out) AS BIGINT) AS bytes_out, CAST(0 AS BIGINT) AS named FROM conv_tos GROUP BY application",
        "sample_index": """WITH RECURSIVE arrivals AS (SELECT user_id, event_id AS arrival, event_id * 7919 % 50 AS ts_ms, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM events),
found AS (SELECT user_id, arrival, ts_ms, nth, 1 AS slot, [ts_ms] AS slots FROM arrivals WHERE nth = 1
 UNION ALL SELECT user_id, arrival, ts_ms, nth, slot, slots[1:slot - 1] || [ts_ms] || slots[slot + 1:] FROM (SELECT a.*, f.slots,
  coalesce(list_position(list_transform(f.slots, lambda held: held < a.ts_ms), true), len(f.slots) + 1) AS slot FROM found f JOIN arrivals a ON a.user_id = f.user_id AND a.nth = f.nth + 1))
SELECT user_id, arrival, ts_ms, CAST(slot - 1 AS INTEGER) AS pane FROM found""",
        "synthetic_flows": _synthetic_sql(),
        "simulated_flows": """SELECT flow_id, node_id, 'fid' || node_id AS foreign_id, node_id + 10 AS if_index, t0 AS delta_switched, t0 + user_id - 1 AS last_switched, num_bytes,
  true AS known_protocol, 15 AS application_length FROM (SELECT event_id AS flow_id, user_id, CAST(user_id % 4 + 1 AS INTEGER) AS node_id,
  1704067200000 + event_id * 700 + CASE WHEN user_id % 4 = 1 THEN 500 ELSE 0 END AS t0, CAST(round(value * 1000) AS BIGINT) AS num_bytes FROM events) WHERE node_id <= 3""",
        "clock_skew": "SELECT DISTINCT CAST(user_id % 7 + 1 AS INTEGER) AS node_id, CAST((user_id % 7) % 3 * 40000 - 40000 AS BIGINT) AS skew_ms FROM events",
        "stream_final_totals": itf, "stream_panes_resummed": itf, "pane_accumulated": itf,
    }
    for key in QUERIES:
        stem = key.removeprefix("topk_").removesuffix("_sum")
        name = {"itf_total": "", "tos_total": "_TOS", "app": "_APPLICATION", "host": "_HOST", "conv": "_CONVERSATION", "app_tos": "_TOS_APPLICATION",
                "host_tos": "_TOS_HOST", "conv_tos": "_TOS_CONVERSATION"}.get(stem)
        if name is not None and key not in out:
            pruned = key.startswith("topk_")
            out[key] = f"{dense} {_grouping_sql(f'EXPORTER_INTERFACE{name}', pruned)}"
    return out
