import ipaddress
import json

import pytest
from pyspark.sql import functions as F

from helpers import BASE, flow, frame
from helpers import COLUMNS as FLOW_COLUMNS
from weft.functions.ip import IPRange, in_ranges, merged, parse_host_filter
from weft.options import Options
from weft.plans.series import samples
from weft.plans.summaries import documents, json_documents, summaries
from weft.sources import protobuf, sinks
from weft.sources.flows import client_properties, kafka_options, normalized
from weft.sources.simulated import REPORT_DDL, exporters, flows_of_reports
from weft.sources.synthetic import FlowConfig, TokenBucket, argument_lists, split, synthetic_flows
from weft.streaming.state import SeriesHeap, indexed, next_index


def address_range(a, b):
    return IPRange(ipaddress.ip_address(a), ipaddress.ip_address(b))


def test_ranges():
    r = address_range("10.0.0.5", "10.0.0.9")
    assert r.size == 5 and ipaddress.ip_address("10.0.0.7") in r and ipaddress.ip_address("::7") not in r
    assert [str(x) for x in r.remove(address_range("10.0.0.6", "10.0.0.7"))] == ["10.0.0.5-10.0.0.5", "10.0.0.8-10.0.0.9"]
    assert r.adjoins(address_range("10.0.0.10", "10.0.0.12")) and str(r.combine(address_range("10.0.0.10", "10.0.0.12"))) == "10.0.0.5-10.0.0.12"
    assert r.comes_before(address_range("::1", "::2")) and not r.overlaps(address_range("::1", "::2"))
    assert [str(x) for x in merged(parse_host_filter("10.0.0.1, 10.0.0.2-10.0.0.4, 10.1.0.7/30"))] == ["10.0.0.1-10.0.0.4", "10.1.0.4-10.1.0.7"]
    assert parse_host_filter(" , ") == []


@pytest.mark.parametrize("text", ["1.2.3.4-1.2.3.5-1.2.3.6", "1.2.3.0/24-1.2.4.0", "host", "1.2.3.9-1.2.3.4", "1.2.3.4/33", "1.2.3.4-::1"])
def test_bad_ranges(text):
    with pytest.raises(ValueError):
        parse_host_filter(text)


def test_in_ranges_of_both_families(spark):
    rows = spark.createDataFrame([("10.0.0.7",), ("10.0.0.77",), ("fe80::1",), ("::1",), ("",), ("x",), (None,), ("1.2.3",)], "a string")
    got = [r.b for r in rows.select(in_ranges(F.col("a"), parse_host_filter("10.0.0.0/28, fe80::/16")).alias("b")).collect()]
    assert got[:2] == [True, False] and got[2] is True and not any(got[3:])


def test_in_ranges_of_a_long_list(spark):
    text = ", ".join([f"10.0.{7 * k % 50}.{k}-10.0.{7 * k % 50}.{k + 9}" for k in range(40)] + [f"fe80::{k:x}00/121" for k in range(1, 9)])
    ranges = parse_host_filter(text)
    addresses = [f"10.0.{a}.{b}" for a in range(0, 52, 3) for b in range(0, 60)] + [f"fe80::{k:x}{n:02x}" for k in range(10) for n in (0, 127, 128)] + ["::", "a:b"]
    got = spark.createDataFrame([(a,) for a in addresses], "a string").select("a", in_ranges(F.col("a"), ranges).alias("b")).collect()
    inside = lambda a: a != "a:b" and any(ipaddress.ip_address(a) in r for r in ranges)
    assert [r.b for r in got] == [inside(r.a) for r in got] and 0 < sum(r.b for r in got) < len(got)


def test_simulated_flows(spark):
    text = json.dumps({"exporters": [
        {"nodeId": 1, "foreignSource": "fs", "foreignId": "a", "location": "l", "inputSnmp": 98, "outputSnmp": 99, "clockOffsetMs": -250},
        {"nodeId": 2, "foreignSource": "fs", "foreignId": "b", "location": "", "inputSnmp": 5, "outputSnmp": 6},
    ]})
    reports = spark.createDataFrame([(k, k % 3 + 1, BASE + k, BASE + k + 1_000, 10 * k) for k in range(300)], REPORT_DDL)
    of = exporters(spark, text)
    rows = {r.flow_id: r for r in flows_of_reports(reports, of, 7).select(*FLOW_COLUMNS).collect()}
    assert set(rows) == {k for k in range(300) if k % 3 < 2}
    one = rows[3]
    assert (one.node_id, one.if_index, one.location, one.delta_switched, one.last_switched, one.num_bytes) == (1, 98, "l", BASE + 3 - 250, BASE + 3 + 999 - 250, 30)
    assert rows[4].delta_switched == BASE + 4 and {r.protocol for r in rows.values()} == {6, 17} and len({r.application for r in rows.values()}) > 50
    names = {(r.src_address, r.src_hostname) for r in rows.values()} | {(r.dst_address, r.dst_hostname) for r in rows.values()}
    assert len(names) == len({a for a, _ in names}) == len({h for _, h in names}) <= 100 and all(ipaddress.IPv4Address(a) for a, _ in names)
    assert rows == {r.flow_id: r for r in flows_of_reports(reports.repartition(3), of, 7).select(*FLOW_COLUMNS).collect()}


def test_protobuf_round_trip_and_failure(spark):
    row = {"node_id": 7, "foreign_source": "fs", "foreign_id": "fid", "direction": "EGRESS", "application": "ssh", "num_bytes": 1 << 40, "protocol": 6,
           "src_address": "a", "dst_address": "b", "first_switched": BASE, "last_switched": BASE + 5, "sampling_interval": 2.5, "output_snmp_ifindex": 3, "dscp": 0}
    got = protobuf.decode_flow(protobuf.encode_flow(row))
    assert {k: got[k] for k in row} == row and got["delta_switched"] is None and got["ecn"] is None and got["input_snmp_ifindex"] is None
    out = normalized(protobuf.decode_flows(spark.createDataFrame([(bytearray(protobuf.encode_flow(row)),)], "value binary"))).first()
    assert (out.delta_switched, out.if_index, out.num_bytes) == (BASE, 3, 1 << 40)
    with pytest.raises(ValueError):
        protobuf.decode_flow(b"\x0a\xff")
    with pytest.raises(Exception, match="truncated"):
        protobuf.decode_flows(spark.createDataFrame([(bytearray(b"\x12\x7f"),)], "value binary")).collect()


def test_client_properties(tmp_path):
    (tmp_path / "p").write_text("# c\nsecurity.protocol=SSL\nbootstrap.servers = a:1\n")
    p = client_properties(str(tmp_path / "p"))
    assert kafka_options("b:2", "t", p) == {"kafka.security.protocol": "SSL", "kafka.bootstrap.servers": "b:2", "subscribe": "t"}
    with pytest.raises(OSError):
        client_properties(str(tmp_path / "none"))


def test_json_documents_and_files(spark, tmp_path):
    rows = json_documents(documents(summaries(frame(spark, flow(num_bytes=5, foreign_source="")))))
    doc = json.loads(rows.where(F.col("document").contains('"EXPORTER_INTERFACE"')).first().document)
    assert doc["exporter"] == {"foreign_source": None, "foreign_id": None, "node_id": 99} and "application" not in doc and doc["@timestamp"] == doc["range_end"]
    sinks.write_ndjson(rows, str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out").glob("index=*")] == ["index=netflow_agg-2017-07"]
    assert b'{"index": {"_index": "i"}}\n{}\n' == sinks.bulk_body([("i", "{}")])


def test_samples(spark):
    got = samples(summaries(frame(spark, flow(num_bytes=5, dscp=2))), fixed={"1x": "y"}).where("metric = 'EXPORTER_INTERFACE_TOS'").collect()
    assert sorted((r.labels["direction"], r.value) for r in got) == [("in", 5.0), ("out", 0.0)]
    assert got[0].labels == got[0].labels | {"_x": "y", "pane": "0", "nodeId": "99", "ifIndex": "98", "dscp": "2"}


def test_remote_write_batches_and_failures():
    series = [sinks.encode_series("m", {"a": "b"}, [(1.5, 10)])] * 5
    assert [len(b) for b in sinks.batches(iter(series), 2, 10**6)] == [2, 2, 1]
    assert [len(b) for b in sinks.batches(iter(series), 10, len(series[0]))] == [1] * 5
    said = iter([200, 400, OSError(), 200, 200])

    def post(url, body, headers, timeout):
        x = next(said)
        if isinstance(x, OSError):
            raise x
        return x

    c = sinks.post_series(iter(series), Options(remote_write_url="u", remote_write_batch=1), post)
    assert (c.writes, c.samples, c.write_failures, c.response_failures) == (5, 5, 1, {400: 1})
    data = bytes(range(256)) * 1000
    block, out, at = sinks.snappy_block(data), b"", 0
    size = shift = 0
    while True:
        size |= (block[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if block[at - 1] < 128:
            break
    while at < len(block):  # literals only
        n = block[at] >> 2
        extra = max(0, n - 59)
        n = int.from_bytes(block[at + 1 : at + 1 + extra], "little") if extra else n
        out += block[at + 1 + extra : at + 2 + extra + n]
        at += 2 + extra + n
    assert out == data and size == len(data)


def test_indexes(spark):
    slots = []
    assert [next_index(slots, t) for t in (5, 3, 4, 6, 6, 6)] == [0, 1, 1, 0, 1, 2]
    rows = spark.createDataFrame([("a", i, t) for i, t in enumerate((5, 3, 4, 6, 6, 6))] + [("b", 9, 1)], "s string, arrival int, ts_ms long")
    got = sorted((r.s, r.arrival, r.pane) for r in indexed(rows, ["s"]).collect())
    assert [p for s, _, p in got if s == "a"] == [0, 1, 1, 0, 1, 2] and got[-1][2] == 0
    heap = SeriesHeap()
    heap.add(20, 1, 100), heap.add(10, 2, 101), heap.add(20, 3, 102)
    assert heap.next_timer(50) == 150 and heap.flush(150, 50) == [(0, 20, 4.0)] and heap.flush(151, 50) == [(1, 10, 2.0)] and heap.next_timer(5) is None


def test_synthetic_flows_split_into_the_same_whole(spark):
    config = FlowConfig(skew_ms=40_000, skew_groups=3)
    whole = synthetic_flows(spark, 1000, config)
    parts = split(spark, 1000, 3, config)
    assert sorted(map(tuple, whole.collect())) == sorted(tuple(r) for p in parts for r in p.collect())
    assert whole.where("delta_switched > last_switched OR num_bytes < 0").count() == 0


def test_token_bucket_resumes():
    now = [0.0]
    a = TokenBucket(10, 5, clock=lambda: now[0])
    taken = []
    for step in range(100):
        now[0] = step * 0.07
        if step == 40:
            a = a.checkpoint()
        taken.append(a.ready())
    assert 65 <= sum(taken) <= 71


def test_argument_lists(tmp_path):
    (tmp_path / "f").write_text("# c\n--a=1 --b=(x|y)\n\n--a=9\n")
    assert list(argument_lists(["--n=(1#2#3)"])) == [["--n=1"], ["--n=3"], ["--n=5"]]
    assert list(argument_lists(["--a=(p|q) & --b=z | --c=0"])) == [["--a=p", "--b=z"], ["--a=q", "--b=z"], ["--c=0"]]
    assert list(argument_lists(["--a=0", f"--include={tmp_path}/f"])) == [["--a=0", "--b=x"], ["--a=0", "--b=y"], ["--a=0"]]
