import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import BASE, flow, frame
from weft.functions.windows import node_shift, start_of_number, window_number, window_start
from weft.operators.flows import conversation_sums, dispatch, packed, prorate, shares, turned, unpacked
from weft.operators.lattice import GROUPINGS, summarize, sums
from weft.options import Options
from weft.plans.summaries import documents, summaries
from weft.queries import QUERIES


def python_shift(node, window):
    h = (node * -1640531527) & 0xFFFFFFFF
    h ^= h >> 16
    return abs(h - (1 << 32) if h >= 1 << 31 else h) % window


def test_shift_of_known_node(spark):
    row = spark.range(1).select(node_shift(F.lit(99), 60_000).alias("a"), node_shift(F.lit(99), 10_000).alias("b")).first()
    assert tuple(row) == (7199, 7199)
    start = spark.range(1).select(window_start(F.lit(BASE), node_shift(F.lit(99), 60_000), 60_000)).first()[0]
    assert start == 1_499_999_947_199


def test_windows_hold_their_times(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(-5, 300), rng.randrange(100_000, 10_000_000)) for _ in range(200)]
    for size in (1, 10, 1000):
        s = node_shift(F.col("node"), size)
        at = spark.createDataFrame(rows, "node int, ts long").select("*", s.alias("s"), window_start(F.col("ts"), s, size).alias("w"), start_of_number(window_number(F.col("ts"), s, size), s, size).alias("v"))
        for r in at.collect():
            assert r.s == python_shift(r.node, size) and r.w == r.v and r.w <= r.ts < r.w + size and (r.w - r.s) % size == 0


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_proration_conserves_bytes(data):
    """The column formula's telescoping, on plain numbers."""
    start, length, size = data.draw(st.integers(0, 1000)), data.draw(st.integers(0, 1000)), data.draw(st.integers(1, 1001))
    total = data.draw(st.integers(0, 1000)) * data.draw(st.one_of(st.just(1.0), st.floats(0.1, 100)))
    end, duration, out = start + length, float(length + 1), 0
    for w in range(start // size, end // size + 1):
        lo, hi = max(start, w * size), min(end, w * size + size - 1)
        out += int((hi - start + 1) * total / duration) - int((lo - start) * total / duration)
    assert out == int(total)


def test_conservation_in_spark(spark):
    rng = random.Random(5)
    rows = [flow(flow_id=i, node_id=rng.randrange(9), delta_switched=BASE + rng.randrange(100_000), last_switched=BASE + 100_000 + rng.randrange(700_000),
                 num_bytes=rng.randrange(10**6), sampling_interval=rng.choice([None, 0.0, 1.5, 10.0])) for i in range(200)]
    got = {r.flow_id: r.b for r in prorate(dispatch(frame(spark, *rows))).groupBy("flow_id").agg(F.sum("bytes").alias("b")).collect()}
    for r in rows:
        assert got[r[0]] == int(r[17] * (r[18] if r[18] else 1.0))


def test_dispatch_to_windows(spark):
    """Flows of 100 to 500 bytes a second over windows of 10 s: the bytes of each window."""
    w0 = BASE - (BASE - 7199) % 10_000
    spans = [(17, 32, 100), (10, 32, 200), (10, 40, 300), (12, 37, 400), (23, 27, 500)]
    rows = [flow(flow_id=i, delta_switched=w0 + 1000 * a, last_switched=w0 + 1000 * b - 1, num_bytes=(b - a) * rate) for i, (a, b, rate) in enumerate(spans)]
    got = prorate(dispatch(frame(spark, *rows), Options(window_ms=10_000))).groupBy("range_start").agg(F.sort_array(F.collect_list("bytes")).alias("b")).collect()
    found = {(r.range_start - w0) // 10_000: r.b for r in got}
    assert found == {1: [300, 2000, 3000, 3200], 2: [1000, 2000, 2000, 3000, 4000], 3: [200, 400, 2800, 3000]}


def test_dispatch_limits(spark):
    long = flow(flow_id=1, delta_switched=0, last_switched=BASE, num_bytes=5)
    early = flow(flow_id=2, delta_switched=100, last_switched=5_000)
    back = flow(flow_id=3, delta_switched=BASE, last_switched=BASE - 200_000)
    none = flow(flow_id=4, delta_switched=None)
    late = flow(flow_id=5, delta_switched=BASE - 2_000_000, last_switched=BASE)
    got = {r.flow_id: r.n for r in dispatch(frame(spark, long, early, back, none, late)).groupBy("flow_id").agg(F.count("*").alias("n")).collect()}
    # a copy every minute, from 15 minutes back on; the flow that starts before the first window of its node is dropped
    assert set(got) == {5}
    assert 15 <= got[5] <= 16


def test_host_names_and_sixteen_documents(spark):
    flows = [
        flow(flow_id=1, src_address="10.0.0.1", dst_address="10.0.0.2", src_hostname="first.src", dst_hostname=None, num_bytes=42),
        flow(flow_id=2, src_address="10.0.0.2", dst_address="10.0.0.3", src_hostname=None, dst_hostname="third.dst", num_bytes=23),
        flow(flow_id=3, src_address="10.0.0.1", dst_address="10.0.0.3", src_hostname=None, dst_hostname="", num_bytes=1337),
    ]
    docs = documents(summaries(frame(spark, *flows))).collect()
    assert len(docs) == 16
    by = {}
    for d in docs:
        by.setdefault(d.grouped_by, []).append(d)
    assert [d.bytes_total for d in by["EXPORTER_INTERFACE"]] == [1402]
    assert {d.host_address: (d.bytes_total, d.host_name) for d in by["EXPORTER_INTERFACE_HOST"]} == {
        "10.0.0.1": (1379, "first.src"), "10.0.0.2": (65, None), "10.0.0.3": (1360, "third.dst"),
    }
    keys = {d.conversation_key for d in by["EXPORTER_INTERFACE_CONVERSATION"]}
    assert '["",6,"10.0.0.1","10.0.0.3","SomeApplication"]' in keys
    assert all(d.exporter.foreign_source == "SomeFs" and d.exporter.node_id == 99 for d in docs)


def test_two_dscps_make_fifteen_documents(spark):
    rows = [flow(flow_id=1, dscp=0, num_bytes=11), flow(flow_id=2, dscp=3, num_bytes=17)]
    docs = documents(summaries(frame(spark, *rows))).collect()
    assert len(docs) == 15
    assert {d.dscp: d.bytes_total for d in docs if d.grouped_by == "EXPORTER_INTERFACE_TOS"} == {0: 11, 3: 17}
    assert [d.bytes_total for d in docs if d.grouped_by == "EXPORTER_INTERFACE"] == [28]


def test_traps(spark):
    own = flow(flow_id=1, src_address="10.0.0.1", dst_address="10.0.0.1", src_hostname="a", dst_hostname="b", num_bytes=10)
    assert [r.bytes_in for r in sums(conversation_sums(frame(spark, own)))["EXPORTER_INTERFACE_HOST"].collect()] == [20]
    partial = flow(flow_id=2, protocol=None, src_address="", num_bytes=7, ecn=None, dscp=None, application="")
    docs = documents(summaries(frame(spark, partial))).collect()
    assert not [d for d in docs if d.grouped_by.endswith("CONVERSATION")]
    assert {d.host_address for d in docs if d.grouped_by == "EXPORTER_INTERFACE_HOST"} == {"", "10.0.0.3"}
    assert all(d.non_ect and not d.congestion_encountered for d in docs)
    assert {d.application for d in docs if d.grouped_by.endswith("APPLICATION")} == {"__unknown"}
    empty = flow(flow_id=3, num_bytes=0, ecn=3)
    assert all(d.congestion_encountered and d.bytes_total == 0 for d in documents(summaries(frame(spark, empty))).collect())
    lost = flow(flow_id=4, node_id=None)
    assert documents(summaries(frame(spark, lost))).count() == 0


def test_ties_and_limits(spark):
    rows = [flow(flow_id=i, application=f"app{i}", num_bytes=5) for i in range(5)]
    rows.append(flow(flow_id=9, application="big", num_bytes=6))
    got = summaries(frame(spark, *rows), Options(top_k=3)).where("grouped_by = 'EXPORTER_INTERFACE_APPLICATION'").collect()
    assert {r.application for r in got} == {"big", "app0", "app1"}
    assert summaries(frame(spark)).count() == 0


@pytest.mark.parametrize("args", [["--top_k=0"], ["--window_ms=-1"], ["--nope=1"], ["--remote_write_hosts=1.2.3.4-1.2.3.1"], ["--elastic_index_strategy=X"]])
def test_bad_options(args):
    with pytest.raises(ValueError):
        Options.from_args(args)


def test_options():
    o = Options.from_args(["--top-k=3", "--remote_write_url=http://x", "--elastic_url="])
    assert (o.top_k, o.writes_series, o.writes_elastic, o.writes_kafka) == (3, True, False, False)


def random_flows(seed, n=150):
    rng = random.Random(seed)
    pick = lambda *v: rng.choice(v)
    return [
        flow(flow_id=i, node_id=pick(None, 1, 2), foreign_id=pick("", "a"), if_index=pick(None, 1, 2), direction=pick("INGRESS", "EGRESS", None), application=pick("", "web", None, "dns"),
             location=pick("", None, "x"), protocol=pick(None, 6, 17), src_address=pick("", None, "h1", "h2", "h3"), dst_address=pick("h1", "h2", ""), src_hostname=pick("", None, "b", "c", "d"),
             dst_hostname=pick("a", None, "", "e"), dscp=pick(None, 0, 4), ecn=pick(None, 0, 3), delta_switched=BASE + (start := rng.randrange(8_000_000)), last_switched=BASE + start + rng.randrange(1_300_000),
             num_bytes=pick(0, 5, 1000), sampling_interval=pick(None, 0.0, 2.5))
        for i in range(n)
    ]


@pytest.mark.parametrize(("seed", "k", "names"), [(1, 2, tuple(GROUPINGS)), (2, 50, tuple(GROUPINGS)), (3, 1, ("EXPORTER_INTERFACE_HOST",)), (4, 3, ("EXPORTER_INTERFACE_TOS_CONVERSATION", "EXPORTER_INTERFACE"))])
def test_flows_are_summed_in_one_branch_as_by_families(spark, seed, k, names):
    """Names differ between windows of a block, texts and numbers are missing, windows lie in several blocks."""
    df, options = frame(spark, *random_flows(seed)), Options(top_k=k)
    got, expected = summaries(df, options, names), summarize(conversation_sums(df, options), k, names)
    assert got.columns == expected.columns and got.dtypes == expected.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


def test_summaries_shuffle_flows_alone(spark, tmp_path):
    """One scan and one exchange, of flows before they are copied to windows, and no sums by sorting."""
    frame(spark, *random_flows(5)).write.parquet(f"{tmp_path}/flows")
    plan = summaries(spark.read.parquet(f"{tmp_path}/flows"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange ") == 1 and "SortAggregate" not in plan
    assert plan.index("Window") < plan.index("HashAggregate") < plan.index("sequence(greatest(__first") < plan.index("Exchange ")


def test_tasks_grow_with_the_flows(spark, tmp_path):
    spark.range(200_000).selectExpr("id", "hash(id) AS x").write.parquet(f"{tmp_path}/t")
    some = spark.read.parquet(f"{tmp_path}/t")
    assert shares(some.unionAll(some).unionAll(some).unionAll(some)) > shares(some) > 1
    assert shares(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "x int")) is None


@pytest.mark.parametrize("name", ["series_filtered_hosts", "flow_summary_docs", "summary_json", "series_samples"])
def test_queries_of_the_whole_job_shuffle_flows_alone(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange ") == 1 and "SortAggregate" not in plan


def test_packed_columns_are_the_same_again(spark):
    """Nulls, empty texts, texts with the marks of the packing and bytes that are no UTF-8."""
    rows = [(1, "a,b:c", None, True, "\u00e9\u65e5", 2.5), (2, "", 5, None, None, None), (3, None, -1, False, "", 0.1), (4, None, None, None, None, None), (5, ":", 0, True, "1,2:", -1e300)]
    df = spark.createDataFrame(rows, "id int, a string, b int, c boolean, d string, e double").withColumn("f", F.when(F.col("b") == 5, F.unhex(F.lit("E697FF")).cast("string")))
    kinds = dict(df.dtypes[1:])
    got = unpacked(packed(df, tuple(kinds)), kinds)
    assert got.dtypes == df.dtypes
    assert got.withColumn("f", F.hex("f")).collect() == df.withColumn("f", F.hex("f")).collect()


@pytest.mark.parametrize("name", ["summary_json", "flow_summary_docs", "series_samples"])
def test_queries_of_the_whole_job_shuffle_narrow_rows(spark, name):
    """Keys of the exchange, times and bytes, and one column for all the rest."""
    node = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().inputPlan()
    while node.nodeName() != "Exchange":
        node = node.children().apply(0)
    columns = {node.output().apply(i).name() for i in range(node.output().length())}
    assert columns == {"node_id", "foreign_source", "foreign_id", "if_index", "block", "delta_switched", "last_switched", "num_bytes", "sampling_interval", "packed"}


def test_packed_texts_may_hold_its_marks(spark):
    texts = ["\x1f", "\x1e", "\x1e0", "\x1e1", "\x1f\x1e\x1f", "a\x1e1\x1f0b", "-", "", None]
    df = spark.createDataFrame([(a, i % 3 == 0, b) for i, a in enumerate(texts) for b in texts], "a string, b boolean, c string")
    assert unpacked(packed(df, ("b", "c", "a")), {"b": "boolean", "c": "string", "a": "string"}).select("a", "b", "c").collect() == df.collect()


def test_packing_costs_a_byte_a_column_at_most(spark):
    df = spark.createDataFrame([("abc", True, False, 5, "")], "a string, b boolean, c boolean, d int, e string")
    assert packed(df, tuple(df.columns)).select(F.octet_length("packed")).first()[0] <= len("abc" "1" "0" "5") + 5


def test_turned_words_are_the_same_again(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, -1, 1 << 40, (1 << 63) - 1, -(1 << 63), -5, None)], "n bigint")
    assert df.select(turned("n", 40).alias("n")).select(turned("n", 24)).collect() == df.collect()
    assert df.where("n = 1").select(turned("n", 40)).first()[0] == 1 << 40


@pytest.mark.parametrize("name", ["flow_summary_docs", "series_samples"])
def test_queries_of_the_whole_job_shuffle_few_bytes(spark, name):
    """55 bytes a flow, as written for the exchange."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        node = QUERIES[name](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    while node.nodeName() != "Exchange":
        node = node.children().apply(0)
    node.execute().count()
    assert node.metrics().apply("shuffleBytesWritten").value() < 55 * 10_000
