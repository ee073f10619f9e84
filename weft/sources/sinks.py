"""Sinks: files by index, bulk requests, Kafka records, remote-write requests."""

from __future__ import annotations

import base64
import json
import logging
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..options import Options
from .protobuf import field as pb
from .protobuf import varint

Post = Callable[[str, bytes, dict[str, str], float], int]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark reaches is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def http_post(url: str, body: bytes, headers: dict[str, str], timeout_s: float) -> int:
    request = urllib.request.Request(url, body, headers)
    try:
        with urllib.request.urlopen(request, timeout=timeout_s) as response:
            return response.status
    except urllib.error.HTTPError as e:
        return e.code


def write_ndjson(documents: DataFrame, path: str) -> None:
    """Documents as JSON lines in one folder for each index."""
    documents.select("index", F.col("document").alias("value")).write.partitionBy("index").mode("append").text(path)


def bulk_body(rows: list[tuple[str, str]]) -> bytes:
    """A bulk request of (index, document)."""
    return "".join(f"{json.dumps({'index': {'_index': index}})}\n{document}\n" for index, document in rows).encode()


def write_elastic(documents: DataFrame, options: Options, post: Post = http_post, batch: int = 1000) -> None:
    """Bulk requests from the executors, retried; a batch that keeps failing fails the task."""
    url = f"{options.elastic_url.rstrip('/')}/_bulk"
    headers = {"Content-Type": "application/x-ndjson"}
    if options.elastic_user:
        token = base64.b64encode(f"{options.elastic_user}:{options.elastic_password}".encode()).decode()
        headers["Authorization"] = f"Basic {token}"
    # one timeout serves connecting and reading: the longer of the two
    timeout = max(options.elastic_socket_timeout_ms, options.elastic_connect_timeout_ms) / 1000
    tries, pause = max(1, options.elastic_retry_count), options.elastic_retry_ms / 1000

    def send(rows) -> None:
        def flush(held: list) -> None:
            for attempt in range(tries):
                try:
                    status = post(url, bulk_body(held), headers, timeout)
                    if status < 300:
                        return
                    failure = f"status {status}"
                except OSError as e:
                    failure = str(e)
                time.sleep(min(pause, 2**attempt) if attempt + 1 < tries else 0)
            raise RuntimeError(f"bulk request failed: {failure}")

        held: list = []
        for part in rows:
            for pair in zip(part["index"].to_pylist(), part["document"].to_pylist(), strict=True):
                held.append(pair)
                if len(held) == batch:
                    flush(held)
                    held = []
        if held:
            flush(held)
        yield from ()

    # a query like any other, so that what is observed in it is reported
    documents.select("index", "document").mapInArrow(send, "n bigint").write.format("noop").mode("overwrite").save()


def kafka_records(documents: DataFrame) -> DataFrame:
    """JSON values without a key, ready for format("kafka")."""
    return documents.select(F.col("document").alias("value"))


def write_kafka(documents: DataFrame, bootstrap: str, topic: str, properties: dict[str, str] | None = None) -> None:
    options = {**(properties or {}), "kafka.bootstrap.servers": bootstrap, "topic": topic}
    kafka_records(documents).write.format("kafka").options(**options).save()


def encode_series(metric: str, labels: dict[str, str], points: list[tuple[float, int]]) -> bytes:
    """One time series; the metric is the label __name__, labels are in order of their names."""
    named = sorted({**labels, "__name__": metric}.items())
    out = b"".join(pb(1, pb(1, k) + pb(2, v)) for k, v in named)
    return out + b"".join(pb(2, pb(1, float(v)) + pb(2, ts)) for v, ts in points)


def write_request(series: list[bytes]) -> bytes:
    return b"".join(pb(1, s) for s in series)


def snappy_block(data: bytes) -> bytes:
    """A valid snappy block of literals only."""
    out = [varint(len(data))]
    for s in range(0, len(data), 65536):
        part = data[s : s + 65536]
        n = len(part) - 1
        out.append(bytes([n << 2]) if n < 60 else bytes([60 << 2, n]) if n < 256 else bytes([61 << 2, n & 255, n >> 8]))
        out.append(part)
    return b"".join(out)


def batches(series: Iterator[bytes], most: int, most_bytes: int) -> Iterator[list[bytes]]:
    """Greedy batches of at most so many series, and so many bytes unless one series alone has more."""
    held, size = [], 0
    for s in series:
        if held and (len(held) >= most or size + len(s) > most_bytes):
            yield held
            held, size = [], 0
        held.append(s)
        size += len(s)
    if held:
        yield held


LOG = logging.getLogger(__name__)


@dataclass
class WriteCounts:
    writes: int = 0
    samples: int = 0
    write_failures: int = 0
    response_failures: dict[int, int] = field(default_factory=dict)


def post_series(series: Iterator[bytes], options: Options, post: Post = http_post) -> WriteCounts:
    """Send batches one after another; failures are counted and never raised."""
    headers = {"Content-Encoding": "snappy", "Content-Type": "application/x-protobuf", "X-Prometheus-Remote-Write-Version": "0.1.0"}
    if options.remote_write_org:
        headers["X-Scope-OrgID"] = options.remote_write_org
    counts = WriteCounts()
    for batch in batches(series, options.remote_write_batch, options.remote_write_batch_bytes):
        counts.writes += 1
        counts.samples += len(batch)
        try:
            status = post(options.remote_write_url, snappy_block(write_request(batch)), headers, 30.0)
            if status >= 300:
                counts.response_failures[status] = counts.response_failures.get(status, 0) + 1
                LOG.warning("write of %d series was answered with status %d", len(batch), status)
        except Exception as e:  # whatever the transport raises: a failed write never fails the job
            counts.write_failures += 1
            LOG.warning("write of %d series failed: %s", len(batch), e)
    return counts


def write_series(samples: DataFrame, options: Options, post: Post = http_post) -> dict[str, int]:
    """Samples to the remote-write endpoint, each series in one partition and in order of time; returns the counts.

    Failed responses are also counted by the hundreds of their status.  A task that is repeated after a loss sends its
    samples again, which the endpoint takes as the same; counts are those of the attempts that ended.
    """
    names = ["writes", "samples", "write_failures", "response_failures", "response_failures_4xx", "response_failures_5xx"]

    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def series() -> Iterator[bytes]:
            for part in rows:
                for metric, labels, ts, value in zip(*(part[c].to_pylist() for c in ("metric", "labels", "ts_ms", "value")), strict=True):
                    yield encode_series(metric, dict(labels), [(value, ts)])

        c = post_series(series(), options, post)
        of = lambda lo, hi: sum(n for status, n in c.response_failures.items() if lo <= status < hi)
        out = (c.writes, c.samples, c.write_failures, of(0, 1000), of(400, 500), of(500, 600))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()) for n in out], names)

    key = F.to_json("labels")
    ordered = samples.withColumn("__key", key).repartition("metric", "__key").sortWithinPartitions("metric", "__key", "ts_ms").drop("__key")
    sent = ordered.select("metric", "labels", "ts_ms", "value").mapInArrow(send, ", ".join(f"{n} bigint" for n in names))
    row = sent.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    return row.asDict()


def discard(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()
