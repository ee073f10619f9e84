"""The summary job as its options say: flows from a source, groupings, and every sink that is switched on.

A batch runs as one plan.  A stream runs as queries that hand over files of a shared folder: flows to panes of summary
rows, these, merged for a while if an accumulation delay is set, to documents and to samples.  Each query has its own
checkpoint, and a micro-batch that is repeated after a loss finds what it wrote and doesn't write it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .metrics import Metrics, document_counts, flow_counts
from .operators.lattice import VALUES
from .options import Options
from .plans.series import considered, samples
from .plans.summaries import documents, json_documents, summaries
from .schema import CONVERSATION, INTERFACE, WINDOW
from .sources import sinks
from .sources.flows import client_properties, kafka_flows, read_flows, stream_flows
from .streaming.modes import run_final, run_panes, run_triggered
from .streaming.state import accumulate, indexed_stream

KEYS = (*WINDOW, "grouped_by", *INTERFACE, "dscp", *CONVERSATION, "grouped_by_key")
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RUNS = {"final": run_final, "triggered": run_triggered, "panes": run_panes}
HANDED_DDL = (
    "range_start bigint, range_end bigint, grouped_by string, node_id int, foreign_source string, foreign_id string, if_index int, dscp int, "
    "location string, protocol int, address string, larger_address string, application string, bytes_in bigint, bytes_out bigint, hostname string, "
    "hostname2 string, congestion boolean, non_ect boolean, grouped_by_key string"
)
Consumer = Callable[[DataFrame], None]


def source(spark: SparkSession, options: Options, kind: str, at: str | DataFrame = "") -> DataFrame:
    """Flows: ``memory`` takes a DataFrame, ``table`` reads a folder, ``files`` streams one, ``kafka`` the options' topic."""
    if kind == "memory":
        return at
    if kind == "table":
        return read_flows(spark, at)
    if kind == "files":
        return stream_flows(spark, at)
    if kind == "kafka":
        properties = client_properties(options.kafka_properties) if options.kafka_properties else None
        return kafka_flows(spark, options.kafka_bootstrap, options.flow_source_topic, properties)
    raise ValueError(f"unknown source {kind!r}")


def document_sinks(options: Options, metrics: Metrics | None = None, post: sinks.Post = sinks.http_post) -> list[Consumer]:
    """What the options switch on for summary rows, as documents."""
    out: list[Consumer] = []
    observed = lambda rows, name: metrics.observe(rows, name, document_counts()) if metrics else rows
    if options.writes_elastic:
        out.append(lambda rows: sinks.write_elastic(json_documents(observed(documents(rows), "to_elastic"), options), options, post))
    if options.writes_kafka:
        properties = client_properties(options.kafka_properties) if options.kafka_properties else None
        out.append(
            lambda rows: sinks.write_kafka(json_documents(observed(documents(rows), "to_kafka"), options), options.kafka_bootstrap, options.flow_dest_topic, properties)
        )
    return out


def run_batch(flows: DataFrame, options: Options, *, consumers: list[Consumer] | None = None, metrics: Metrics | None = None, post: sinks.Post = sinks.http_post,
              fixed_labels: dict[str, str] | None = None) -> dict[str, int]:
    """All flows once, to the options' sinks or to ``consumers`` of summary rows; returns the counts of written samples."""
    observed = metrics.observe(flows, "flows", flow_counts()) if metrics else flows
    rows = summaries(observed, options).persist()
    try:
        for consume in document_sinks(options, metrics, post) if consumers is None else consumers:
            consume(rows)
        if options.writes_series:
            return sinks.write_series(samples(considered(rows, options), fixed=fixed_labels), options, post)
        return {}
    finally:
        rows.unpersist()


def hand_over(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps a micro-batch's rows in a folder of their own, written once however often the batch is repeated.

    Micro-batches without rows, as keyed state that waits for its timers makes all the time, leave no folder.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            first = rows.head(1)
            if not first:
                return
            pane = first[0]["pane"] if "pane" in rows.columns else None
            at = f"{path}/batch={batch_id:09d}" + ("" if pane is None else f"-{pane}")
            if not sinks.path_exists(rows.sparkSession, f"{at}/_SUCCESS"):
                rows.select(*KEYS, *VALUES).write.mode("overwrite").parquet(at)
        finally:
            rows.unpersist()

    return write


def _made(spark: SparkSession, path: str) -> str:
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(fs)
    return path


def handed_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows that were handed over under a path."""
    return spark.read.schema(HANDED_DDL).option("recursiveFileLookup", "true").parquet(_made(spark, path))


def handed(spark: SparkSession, path: str) -> DataFrame:
    """The rows that arrive under a path, with a watermark at the newest window's last millisecond."""
    rows = spark.readStream.schema(HANDED_DDL).option("recursiveFileLookup", "true").parquet(_made(spark, path))
    return rows.withColumn("at", F.timestamp_millis(F.col("range_end") - 1)).withWatermark("at", "0 milliseconds")


def start(flows: DataFrame, options: Options, folder: str, *, mode: str = "triggered", consumers: list[Consumer] | None = None,
          metrics: Metrics | None = None, post: sinks.Post = sinks.http_post, trigger: dict | None = None) -> list[StreamingQuery]:
    """Start the queries of a streaming run; ``folder`` is shared by driver and executors and holds all its state.

    ``consumers`` of summary rows replace the options' document sinks; ``trigger`` are arguments of Spark's trigger.
    """
    spark = flows.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKS:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    if metrics:
        spark.streams.addListener(metrics)
        flows = metrics.observe(flows, "flows", flow_counts())
    trigger, queries = trigger or {"processingTime": "1 second"}, []

    def begin(writer, name: str) -> None:
        queries.append(writer.option("checkpointLocation", f"{folder}/checkpoints/{name}").trigger(**trigger).start())

    more = {"panes": {"floor_path": f"{folder}/floor"}, "final": {"cap_now": True}}.get(mode, {})
    begin(RUNS[mode](flows, hand_over(f"{folder}/summaries"), options, **more), "summaries")
    ready = f"{folder}/summaries"
    if options.accumulation_delay_ms:
        merged = accumulate(handed(spark, ready), KEYS, options.accumulation_delay_ms, options.allowed_lateness_ms)
        ready = f"{folder}/accumulated"
        begin(merged.writeStream.foreachBatch(hand_over(ready)), "accumulated")
    writers = document_sinks(options, metrics, post) if consumers is None else consumers

    def deliver(rows: DataFrame, batch_id: int) -> None:
        rows = rows.drop("at").persist()
        try:
            for write in writers:
                write(rows)
        finally:
            rows.unpersist()

    if writers:
        begin(handed(spark, ready).writeStream.foreachBatch(deliver), "documents")
    if options.writes_series:
        rows = considered(handed(spark, ready), options)
        pointed = indexed_stream(samples(rows, keep=("at",)), options.remote_write_accumulation_ms, options.allowed_lateness_ms)
        begin(pointed.writeStream.foreachBatch(lambda batch, _: sinks.write_series(batch, options, post)), "series")
    return queries


def main(args: list[str], spark: SparkSession | None = None) -> None:
    """``--source=kafka|files|table``, ``--at=path``, ``--mode=...``, ``--folder=path``, and the options."""
    own = {"source": "kafka", "at": "", "mode": "triggered", "folder": ""}
    rest = []
    for arg in args:
        name, sep, value = arg.removeprefix("--").partition("=")
        if sep and name in own:
            own[name] = value
        else:
            rest.append(arg)
    options = Options.from_args(rest)
    spark = spark or SparkSession.builder.appName("weft").getOrCreate()
    flows = source(spark, options, own["source"], own["at"])
    if not flows.isStreaming:
        run_batch(flows, options)
        return
    if not own["folder"]:
        raise ValueError("a stream needs --folder, shared by driver and executors")
    start(flows, options, own["folder"], mode=own["mode"])
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    import sys

    main(sys.argv[1:])
