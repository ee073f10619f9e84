import struct
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from helpers import BASE, flow, frame, same_as_sql
from weft import job, queries
from weft.metrics import Metrics, flow_counts
from weft.operators.flows import dispatch
from weft.options import Options
from weft.plans.summaries import summaries
from weft.sources.flows import stream_flows
from weft.sources.synthetic import current_time_ends, flows_of
from weft.sources.unbounded import SyntheticFlows, register
from weft.streaming.modes import run_final, watermark_delay_ms
from weft.streaming.state import PaneAccumulator, PaneTrigger, SeriesAccumulator, SeriesIndexer


def test_watermark_delay():
    assert watermark_delay_ms(Options()) == 1_080_000 and watermark_delay_ms(Options(), lossless=False) == 14_580_000


def test_final_and_panes_equal_the_batch(spark):
    for name in ("stream_final_totals", "stream_panes_resummed", "pane_accumulated"):
        same_as_sql(spark, name, queries.QUERIES[name], queries.oracle_sql()[name])


class Fake:
    """Handle, state, clock and expired timer of one key."""

    def __init__(self, processor, key):
        self.processor, self.key, self.value, self.timers, self.now, self.mark = processor, key, None, set(), 0, 0
        processor.init(self)

    def getValueState(self, name, ddl):  # noqa: N802
        return self

    exists = lambda self: self.value is not None
    get = lambda self: self.value
    update = lambda self, value: setattr(self, "value", value)
    clear = lambda self: setattr(self, "value", None)
    registerTimer = lambda self, at: self.timers.add(at)
    deleteTimer = lambda self, at: self.timers.discard(at)
    getCurrentProcessingTimeInMs = lambda self: self.now
    getCurrentWatermarkInMs = lambda self: self.mark

    def feed(self, *rows):
        return [tuple(r) for r in self.processor.handleInputRows(self.key, iter(rows), self)]

    def go(self, now, mark=None):
        """Processing time goes on to ``now``; what expired timers say."""
        out = []
        while due := sorted(t for t in self.timers if t <= now):
            self.now = max(self.now, due[0])
            self.timers.discard(due[0])
            out += [tuple(r) for r in self.processor.handleExpiredTimer(self.key, self, type("T", (), {"getExpiryTimeInMs": lambda _, t=due[0]: t})())]
            if self.now + 1 > now:
                break
        self.now, self.mark = now, self.mark if mark is None else mark
        return out


class V(dict):
    __getattr__ = dict.__getitem__


def value(n, out=0, name=None, name2=None, ce=False, ect=False):
    return V(bytes_in=n, bytes_out=out, hostname=name, hostname2=name2, congestion=ce, non_ect=ect)


def test_trigger_fires_on_time_and_late_and_drops_what_is_too_late():
    f = Fake(PaneTrigger(early_ms=0, late_ms=5_000, lateness_ms=100_000), (0, 60_000))
    assert f.feed(value(100, name="b")) == [] == f.feed(value(103, name="a", ect=True))
    f.mark = 59_999
    assert f.go(90_000) == []
    f.mark = 60_000
    assert f.go(95_000) == [(0, 60_000, 203, 0, "a", None, False, True, "ON_TIME", 0)]
    assert f.go(96_000) == [] and f.feed(value(112)) == []
    assert f.go(100_000) == [] and f.feed(value(1)) == []
    assert f.go(101_500) == [(0, 60_000, 113, 0, None, None, False, False, "LATE", 1)]
    assert f.feed(value(7)) == []
    f.mark = 160_000
    assert f.go(102_000) == [] and f.go(300_000) == [(0, 60_000, 7, 0, None, None, False, False, "LATE", 2)]
    assert f.value is None and not f.timers and f.feed(value(9)) == [] and f.value is None
    # the first row of a window comes after its end: it fires at once, and no pane without rows ever does
    g = Fake(PaneTrigger(0, 5_000, 100_000), (0, 60_000))
    g.mark = 70_000
    assert [r[2] for r in g.feed(value(4))] == [4] and g.go(20_000) == []


def test_trigger_fires_early_panes():
    f = Fake(PaneTrigger(early_ms=2_000, late_ms=5_000, lateness_ms=0), (0, 60_000))
    assert f.feed(value(1)) == [] and f.go(1_000) == [] and f.feed(value(2)) == []
    assert [(r[2], r[-2:]) for r in f.go(2_500)] == [(3, ("EARLY", 0))]
    assert f.go(10_000) == [] and f.feed(value(5)) == []
    f.mark = 60_000
    assert [(r[2], r[-2:]) for r in f.feed(value(6))] == [(11, ("ON_TIME", 1))]
    assert f.value is None and not f.timers  # no lateness is allowed


def test_pane_accumulator_merges_within_its_delay_and_emits_when_its_window_expires():
    f = Fake(PaneAccumulator(8_000, 10_000, end=1), ("k", 60_000))
    assert f.feed(value(5, 1, "b", "z", ect=True)) == []
    f.now = 7_000
    assert f.feed(value(7, 2, "", "y", ce=True), value(1, name="a")) == []
    assert f.go(7_900) == [] and f.go(8_100) == [("k", 60_000, 13, 3, "a", "y", True, True)]
    assert f.value is None and not f.timers and f.feed(value(1)) == []
    f.mark = 70_000
    assert f.go(11_000) == [("k", 60_000, 1, 0, None, None, False, False)]
    assert f.feed(value(2)) == [("k", 60_000, 2, 0, None, None, False, False)] and f.value is None and not f.timers


def sample(ts, v=1.0):
    return V(ts_ms=ts, value=v)


def test_series_indexes_rise_and_are_dropped_in_the_end():
    f = Fake(SeriesIndexer(lateness_ms=1_000), ("m", "s"))
    assert [r[-1] for r in f.feed(*map(sample, (5, 3, 4)))] == [0, 1, 1] and [r[-1] for r in f.feed(*map(sample, (6, 6, 6)))] == [0, 1, 2]
    f.go(10_000, 1_006)
    assert f.value is not None
    f.mark = 1_007
    f.go(20_000)
    assert f.value is None and not f.timers and [r[-1] for r in f.feed(sample(2_000))] == [0]


def test_series_accumulate_and_flush_when_they_expire():
    f = Fake(SeriesAccumulator(50, lateness_ms=1_000), ("m", "s"))
    f.now = 100
    assert f.feed(sample(20, 1.0)) == []
    f.now = 101
    assert f.feed(sample(10, 2.0)) == []
    f.now = 102
    assert f.feed(sample(20, 3.0)) == []
    assert f.go(149) == [] and f.go(150) == [("m", "s", 20, 4.0, 0)] and f.go(151) == [("m", "s", 10, 2.0, 1)]
    f.now = 200
    assert f.feed(sample(30, 1.5)) == []
    f.mark = 1_031
    assert f.feed(sample(25, 2.5)) == [("m", "s", 25, 2.5, 0), ("m", "s", 30, 1.5, 0)] and f.value is None and not f.timers


class Server:
    """Takes requests and remembers them; answers with the statuses given, then 200."""

    def __enter__(self):
        self.got, self.say = [], []
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):  # noqa: N802
                outer.got.append((self.path, dict(self.headers), self.rfile.read(int(self.headers["Content-Length"]))))
                self.send_response(outer.say.pop(0) if outer.say else 200)
                self.end_headers()

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}"
        return self

    def __exit__(self, *_):
        self.server.shutdown()
        self.server.server_close()

    def documents(self):
        import json

        lines = [x for path, _, body in self.got if path == "/_bulk" for x in body.decode().splitlines()]
        return [(json.loads(a)["index"]["_index"], json.loads(b)) for a, b in zip(lines[::2], lines[1::2], strict=True)]


def test_batch_job_writes_what_its_options_switch_on(spark):
    rows = [flow(num_bytes=5), flow(num_bytes=7, node_id=None), flow(num_bytes=9, dst_address="10.0.0.9")]
    with Server() as s:
        s.say = [503]  # retried
        options = Options(elastic_url=s.url, elastic_user="u", elastic_password="p", remote_write_url=f"{s.url}/push", remote_write_org="o", remote_write_batch=3, elastic_retry_ms=1)
        metrics = Metrics()
        counts = job.run_batch(job.source(spark, options, "memory", frame(spark, *rows).coalesce(1)), options, metrics=metrics, fixed_labels={"run": "1"})
        expected = summaries(frame(spark, *rows), options)
        found = s.documents()
        assert len({str(d) for d in found}) == expected.count() and {i for i, _ in found} == {"netflow_agg-2017-07"}
        assert all(h["Authorization"] == "Basic dTpw" for p, h, _ in s.got if p == "/_bulk")
        pushes = [(h, b) for p, h, b in s.got if p == "/push"]
        assert len(pushes) == counts["writes"] and all(h["X-Scope-Orgid"] == "o" and h["Content-Encoding"] == "snappy" for h, _ in pushes)
        assert counts["samples"] == 2 * expected.where("grouped_by NOT LIKE '%HOST' AND grouped_by NOT LIKE '%CONVERSATION'").count() and counts["write_failures"] == 0
        seen = metrics.collect()
        assert (seen["flows"]["count"], seen["flows"]["missing_fields"], seen["to_elastic"]["count"]) == (3, 1, expected.count())
        s.say = [400, 500, 302]
        failed = job.run_batch(frame(spark, *rows).coalesce(1), options, consumers=[])
        assert (failed["response_failures"], failed["response_failures_4xx"], failed["response_failures_5xx"]) == (3, 1, 1)
    gone = job.run_batch(frame(spark, *rows), options, consumers=[])
    assert gone["write_failures"] == gone["writes"] > 0
    with pytest.raises(Exception, match="bulk request failed"):
        job.run_batch(frame(spark, *rows), Options(elastic_url=s.url, elastic_retry_ms=1))
    with pytest.raises(ValueError, match="unknown source"):
        job.source(spark, options, "pigeon")


def settle(wanted, seconds=60):
    end = time.time() + seconds
    while time.time() < end and not wanted():
        time.sleep(0.5)
    assert wanted()


def test_streaming_job_with_late_flows(spark, tmp_path):
    """Flows of one node a window apart, then a late one for the first window, then one a day late."""
    first = dispatch(frame(spark, flow())).first().range_start
    offsets = [0, 30_000, 60_000, 1_200_000]
    flows = [flow(delta_switched=first + at, last_switched=first + at + 29_999, num_bytes=100 + 3 * k) for k, at in enumerate(offsets)]
    late = [flow(delta_switched=first, last_switched=first + 29_999, num_bytes=112)]
    lost = [flow(delta_switched=first - 86_400_000, last_switched=first - 86_400_000 + 29_999, num_bytes=1)]
    put = lambda rows: frame(spark, *rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    put(flows)
    with Server() as s:
        options = Options(elastic_url=s.url, max_input_delay_ms=0, late_delay_ms=1_000)
        metrics = Metrics()
        running = job.start(job.source(spark, options, "files", str(tmp_path / "in")), options, str(tmp_path / "run"), metrics=metrics, trigger={"processingTime": "300 milliseconds"})

        def totals(*windows):
            return sorted(d["bytes_ingress"] for _, d in s.documents() if d["grouped_by"] == "EXPORTER_INTERFACE" and d["range_start"] in windows)

        try:
            settle(lambda: totals(first) == [203])
            put(late)
            put(lost)
            settle(lambda: totals(first) == [112, 203])
            assert totals(first - 86_400_000) == [] and all(q.isActive for q in running)
            assert metrics.snapshot("flows").count == len(flows) + 2
        finally:
            for q in running:
                q.stop()
            spark.streams.removeListener(metrics)


def fields(data):
    """(number, value) of a protobuf message."""
    at = 0

    def number():
        nonlocal at
        out = shift = 0
        while True:
            at += 1
            out |= (data[at - 1] & 127) << shift
            shift += 7
            if data[at - 1] < 128:
                return out

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            n = 8 if tag & 7 == 1 else number()
            yield tag >> 3, data[at : at + n]
            at += n


def pushed(server):
    """(labels, time, value) of all samples that came."""
    out = []
    for path, _, block in server.got:
        if path == "/push":
            at = next(k for k, b in enumerate(block) if b < 128) + 1
            data = b""
            while at < len(block):  # literals only
                n = block[at] >> 2
                extra = max(0, n - 59)
                n = int.from_bytes(block[at + 1 : at + 1 + extra], "little") if extra else n
                data += block[at + 1 + extra : at + 2 + extra + n]
                at += 2 + extra + n
            for _, series in fields(data):
                parts = list(fields(series))
                labels = {a.decode(): b.decode() for a, b in (dict(fields(v)).values() for k, v in parts if k == 1)}
                out += [(labels, dict(fields(v))[2], struct.unpack("<d", dict(fields(v)).get(1, bytes(8)))[0]) for k, v in parts if k == 2]
    return out


@pytest.mark.parametrize("merging", [0, 1_500])
def test_streaming_job_writes_series_with_indexes(spark, tmp_path, merging):
    """Two panes of one window are two samples with indexes 0 and 1, or samples that add up to them."""
    put = lambda n: frame(spark, flow(num_bytes=n)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    put(5)
    with Server() as s:
        options = Options(elastic_url="", remote_write_url=f"{s.url}/push", remote_write_accumulation_ms=merging, accumulation_delay_ms=merging)
        running = job.start(
            job.source(spark, options, "files", str(tmp_path / "in")), options, str(tmp_path / "run"), mode="panes", consumers=[], trigger={"processingTime": "300 milliseconds"}
        )
        totals = lambda: [(x["pane"], ts, v) for x, ts, v in pushed(s) if x["__name__"] == "EXPORTER_INTERFACE" and x["direction"] == "in"]
        try:
            settle(lambda: merging or totals())
            put(7)
            settle(lambda: sum(v for _, _, v in totals()) == 12)
            found = totals()
            assert len({ts for _, ts, _ in found}) == 1 and len({(p, ts) for p, ts, _ in found}) == len(found) and all(q.isActive for q in running)
            time.sleep(2)  # idle micro-batches leave nothing behind
            assert 1 <= len(list((tmp_path / "run" / ("accumulated" if merging else "summaries")).glob("batch=*"))) <= 2
            if not merging:
                assert [(p, v) for p, _, v in found] == [("0", 5.0), ("1", 7.0)]
        finally:
            for q in running:
                q.stop()


def test_panes_go_on_with_their_floor_after_a_restart(spark, tmp_path):
    options, rows = Options(elastic_url="", max_input_delay_ms=0, allowed_lateness_ms=60_000), []
    take = lambda df: rows.extend(df.where("grouped_by = 'EXPORTER_INTERFACE'").collect())
    for batch in ([flow(num_bytes=5, delta_switched=BASE + 600_000, last_switched=BASE + 600_000)], [flow(num_bytes=7)], [flow(num_bytes=9, last_switched=BASE + 700_000, delta_switched=BASE + 700_000)]):
        frame(spark, *batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for q in job.start(job.source(spark, options, "files", str(tmp_path / "in")), options, str(tmp_path / "run"), mode="panes", consumers=[take], trigger={"availableNow": True}):
            q.awaitTermination()
        for q in job.start(job.source(spark, options, "files", str(tmp_path / "in")), options, str(tmp_path / "run"), mode="panes", consumers=[take], trigger={"availableNow": True}):
            q.awaitTermination()
    assert sorted(r.bytes_in for r in rows) == [5, 9]


def test_metrics_of_a_batch(spark):
    metrics = Metrics()
    metrics.observe(frame(spark, flow(), flow(node_id=None)), "flows", flow_counts()).collect()
    metrics.observe(frame(spark, flow()), "flows", flow_counts()).collect()
    got = metrics.collect()["flows"]
    assert (got["count"], got["missing_fields"]) == (3, 1) and got["drift_ms"] > 0 and metrics.snapshot("flows").rate >= 0


def test_unbounded_source_splits_and_goes_on_where_it_was(spark, tmp_path):
    register(spark)
    read = lambda n: spark.readStream.format(SyntheticFlows.name()).option("flows", n).option("perSecond", 0).option("splits", 3).load()
    for n in (1000, 2500):  # a restarted run goes on behind the flows of the first
        query = read(n).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        assert sorted(r.idx for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(n))
    source = SyntheticFlows({"flows": "100", "perSecond": "10", "start": "2"}).streamReader(None)
    for now, index in ((0.0, 0), (5.0, 30), (50.0, 100)):
        source.clock = lambda now=now: now
        assert source.latestOffset() == {"index": index}
    assert source.initialOffset() == {"index": 0}
    with pytest.raises(ValueError, match="needs a start"):
        SyntheticFlows({"perSecond": "10"}).streamReader(None)
    split = source.partitions({"index": 7}, {"index": 30})
    assert sorted(i for p in split for (i,) in source.read(p)) == list(range(7, 30)) and len(split) > 1
    flows = SyntheticFlows.flows(read(1000))
    assert flows.isStreaming and {"node_id", "last_switched"} <= set(flows.columns)
    assert flows_of(spark.range(3).withColumnRenamed("id", "idx"), ends=current_time_ends()).where(F.col("last_switched") > BASE).count() == 3


@pytest.mark.parametrize("names", [("EXPORTER_INTERFACE",), ("EXPORTER_INTERFACE_TOS_HOST", "EXPORTER_INTERFACE_APPLICATION"), ("EXPORTER_INTERFACE_CONVERSATION",)])
def test_state_of_final_windows_holds_what_the_groupings_tell_apart(spark, tmp_path, names):
    rows = [
        flow(flow_id=i, src_address=f"10.0.{i % 7}.1", dst_address=f"10.1.{i % 5}.1", src_hostname=f"h{i % 9}", application=f"app{i % 3}", dscp=i % 2, num_bytes=i, delta_switched=BASE + i, last_switched=BASE + 90_000 + i)
        for i in range(210)
    ]
    frame(spark, *rows).coalesce(1).write.parquet(f"{tmp_path}/in")
    late = flow(flow_id=999, node_id=-1, delta_switched=4_000_000_000_000, last_switched=4_000_000_000_000)
    for _ in range(2):
        frame(spark, late).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    found, options = [], Options(top_k=3)
    stream = stream_flows(spark, f"{tmp_path}/in", files_per_trigger=1)
    writer = run_final(stream, lambda batch, _: found.extend(batch.where("node_id > 0").collect()), options, names=names)
    query = writer.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(repr, found)) == sorted(map(repr, summaries(frame(spark, *rows), options, names).collect()))
    if names == ("EXPORTER_INTERFACE",):  # a row a window, and not a row a conversation
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 4
