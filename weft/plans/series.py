"""Labelled time-series samples of summary rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ip import in_ranges, parse_host_filter
from ..functions.names import sanitize_label, sanitize_metric
from ..options import Options

#: Metric names of the groupings; those of top-k groupings go on with node and interface.
METRICS = {
    "EXPORTER_INTERFACE": "EXPORTER_INTERFACE", "EXPORTER_INTERFACE_TOS": "EXPORTER_INTERFACE_TOS",
    "EXPORTER_INTERFACE_APPLICATION": "BY_APP", "EXPORTER_INTERFACE_HOST": "BY_HOST", "EXPORTER_INTERFACE_CONVERSATION": "BY_CONV",
    "EXPORTER_INTERFACE_TOS_APPLICATION": "BY_TOS_AND_APP", "EXPORTER_INTERFACE_TOS_HOST": "BY_TOS_AND_HOST",
    "EXPORTER_INTERFACE_TOS_CONVERSATION": "BY_TOS_AND_CONV",
}


def considered(rows: DataFrame, options: Options = Options()) -> DataFrame:  # noqa: B008
    """Rows that are written as samples: no conversations, hosts only if the host filter names them."""
    by, ranges = F.col("grouped_by"), parse_host_filter(options.remote_write_hosts)
    host_ok = in_ranges(F.col("address"), ranges) if ranges else F.lit(False)
    return rows.where(~by.endswith("CONVERSATION") & (~by.endswith("HOST") | host_ok))


def metric_name() -> Column:
    names = F.create_map(*[F.lit(x) for pair in METRICS.items() for x in pair])[F.col("grouped_by")]
    total = F.col("grouped_by").isin("EXPORTER_INTERFACE", "EXPORTER_INTERFACE_TOS")
    return sanitize_metric(F.when(total, names).otherwise(F.concat_ws("_", names, "node_id", "if_index")))


def labels(direction: Column, pane: Column, fixed: dict[str, str]) -> Column:
    """Labels that apply to the row's grouping; a null value is no label."""
    by = F.col("grouped_by")
    conversation, tos, total = by.endswith("CONVERSATION"), by.contains("TOS"), by.isin("EXPORTER_INTERFACE", "EXPORTER_INTERFACE_TOS")
    text = lambda c, when: F.when(when, F.col(c).cast("string"))
    pairs = [
        *[(k, F.lit(v)) for k, v in fixed.items()], ("pane", pane.cast("string")), ("direction", direction),
        ("nodeId", text("node_id", total)), ("ifIndex", text("if_index", total)), ("dscp", text("dscp", tos)),
        ("location", text("location", conversation)), ("protocol", text("protocol", conversation)),
        ("host", text("address", conversation | by.endswith("HOST"))), ("host2", text("larger_address", conversation)),
        ("application", text("application", conversation | by.endswith("APPLICATION"))),
    ]
    return F.map_filter(F.create_map(*[x for k, v in pairs for x in (sanitize_label(F.lit(k)), v)]), lambda _, v: v.isNotNull())


def samples(rows: DataFrame, *, pane: Column | None = None, fixed: dict[str, str] | None = None, metric: str | None = None,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """(metric, labels, ts_ms, value) and columns to keep: two samples a row, at the last millisecond of its range."""
    name = sanitize_metric(F.lit(metric)) if metric else metric_name()
    both = F.array(*[F.struct(F.lit(d).alias("direction"), F.col(c).cast("double").alias("value")) for d, c in (("in", "bytes_in"), ("out", "bytes_out"))])
    return rows.withColumn("__metric", name).withColumn("__s", F.explode(both)).select(
        F.col("__metric").alias("metric"), labels(F.col("__s.direction"), F.lit(0) if pane is None else pane, fixed or {}).alias("labels"),
        (F.col("range_end") - 1).alias("ts_ms"), F.col("__s.value").alias("value"), *keep,
    )
