"""Synthetic flows from an index: deterministic hashes instead of a sequential random generator, so any split agrees."""

from __future__ import annotations

import itertools
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FlowConfig:
    seed: int = 1
    start_ms: int = 1_500_000_000_000
    min_exporter: int = 1
    exporters: int = 5
    min_interface: int = 3
    interfaces: int = 4
    protocols: int = 2
    applications: int = 10
    hosts: int = 5
    ecns: int = 4
    dscps: int = 17
    sigma_ms: int = 1_000  # of the end around its place
    mean_duration_ms: int = 1_000
    window_ms: int = 60_000
    flows_per_window: int = 1_000
    skew_ms: int = 0
    skew_groups: int = 1
    skew_direction: str = "BOTH"  # AHEAD, BEHIND or BOTH


def clock_skew(node: Column, config: FlowConfig) -> Column:
    """Milliseconds that a node's clock is off: its group times the skew, centred for BOTH."""
    if config.skew_groups == 1:
        return F.lit(0).cast("bigint")
    step = -abs(config.skew_ms) if config.skew_direction == "BEHIND" else abs(config.skew_ms)
    centre = step * (config.skew_groups - 1) // 2 if config.skew_direction == "BOTH" else 0
    return ((node - config.min_exporter) % config.skew_groups).cast("bigint") * step - centre


def _uniform(config: FlowConfig, salt: int) -> Column:
    """(0, 1], from the index."""
    return (F.pmod(F.xxhash64(F.lit(config.seed), F.lit(salt), "idx"), F.lit(1_000)) + 1) / F.lit(1000.0)


def _pick(config: FlowConfig, salt: int, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(config.seed), F.lit(salt), "idx"), F.lit(n)).cast("int")


def linear_ends(start_ms: int, step_ms: float) -> Column:
    return F.lit(start_ms) + F.floor(F.col("idx") * F.lit(float(step_ms))).cast("bigint")


def uniform_in_window_ends(config: FlowConfig) -> Column:
    return linear_ends(config.start_ms, config.window_ms // config.flows_per_window if config.window_ms >= config.flows_per_window else config.window_ms / config.flows_per_window)


def synthetic_flows(spark: SparkSession, n: int, config: FlowConfig = FlowConfig(), *, ends: Column | None = None, of: int = 1, part: int = 0) -> DataFrame:  # noqa: B008
    """Flows 0 to n - 1, or every ``of``-th from ``part``."""
    return flows_of(spark.range(part, n, of).withColumnRenamed("id", "idx"), config, ends=ends)


def current_time_ends() -> Column:
    """Ends at the time of processing."""
    return F.unix_millis(F.current_timestamp())


def flows_of(indexes: DataFrame, config: FlowConfig = FlowConfig(), *, ends: Column | None = None) -> DataFrame:  # noqa: B008
    """The flows of rows (idx), of a batch or a stream: ends near their place, exponential durations, bytes that fall off
    with the numbers of application and hosts.
    """
    rows = indexes.withColumns({
        "node_id": _pick(config, 1, config.exporters) + config.min_exporter, "if_index": _pick(config, 2, config.interfaces) + config.min_interface,
        "protocol": _pick(config, 3, config.protocols), "__app": _pick(config, 4, config.applications),
        "__src": _pick(config, 5, config.hosts), "__dst": _pick(config, 6, config.hosts), "ecn": _pick(config, 7, config.ecns), "dscp": _pick(config, 8, config.dscps),
    })
    normal = F.sqrt(-2 * F.log(_uniform(config, 9))) * F.cos(2 * F.pi() * _uniform(config, 10))
    place = uniform_in_window_ends(config) if ends is None else ends
    last = place + F.floor(normal * config.sigma_ms).cast("bigint") + clock_skew(F.col("node_id"), config)
    duration = F.floor(-F.log(_uniform(config, 11)) * config.mean_duration_ms).cast("bigint")
    share = F.exp(-0.5 * (F.col("__app") + F.col("__src") + F.col("__dst"))) * 0.5
    size = F.floor(_pick(config, 12, 1 << 20) * share).cast("bigint")
    host = lambda c: F.concat(F.lit("127.0.0."), F.col(c).cast("string"))
    return rows.withColumn("last_switched", last).select(
        F.col("idx").alias("flow_id"), "node_id", F.lit(None).cast("string").alias("foreign_source"), F.lit(None).cast("string").alias("foreign_id"),
        "if_index", F.when(_pick(config, 13, 2) == 0, F.lit("INGRESS")).otherwise(F.lit("EGRESS")).alias("direction"),
        F.concat(F.lit("app"), F.col("__app").cast("string")).alias("application"), F.lit("").alias("location"), "protocol",
        host("__src").alias("src_address"), host("__dst").alias("dst_address"),
        F.concat(F.lit("host"), F.col("__src").cast("string")).alias("src_hostname"), F.concat(F.lit("host"), F.col("__dst").cast("string")).alias("dst_hostname"),
        "dscp", "ecn", (F.col("last_switched") - duration).alias("delta_switched"), "last_switched", size.alias("num_bytes"),
        F.lit(None).cast("double").alias("sampling_interval"),
    )


def split(spark: SparkSession, n: int, parts: int, config: FlowConfig = FlowConfig()) -> list[DataFrame]:  # noqa: B008
    """The flows in parts that together are the whole."""
    return [synthetic_flows(spark, n, config, of=parts, part=k) for k in range(parts)]


ROW_GROUP = 8 << 20  # bytes, so that several tasks read a file


def ingest(flows: DataFrame, folder: str, files: int, *, limiter: TokenBucket | None = None) -> None:
    """Write flows as files in the order of their ends, at the limiter's pace, for a file stream to pick up."""
    bounds = [int(x) for x in flows.approxQuantile("last_switched", [k / files for k in range(1, files)], 0.0)]
    edges = [None, *bounds, None]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        part = flows if lo is None else flows.where(F.col("last_switched") > lo)
        part = part if hi is None else part.where(F.col("last_switched") <= hi)
        if limiter:
            limiter.take(1)
        part.coalesce(1).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(folder)


@dataclass
class TokenBucket:
    """A rate limiter whose state is plain numbers, so it can be checkpointed and resumed."""

    per_second: float
    room: float
    level: float = 0.0
    at: float | None = None
    clock: Callable[[], float] = time.monotonic

    def ready(self, n: float = 1) -> bool:
        now = self.clock()
        self.level = min(self.room, self.level + (0 if self.at is None else (now - self.at) * self.per_second))
        self.at = now
        if self.level < n:
            return False
        self.level -= n
        return True

    def take(self, n: float = 1) -> None:
        while not self.ready(n):
            time.sleep(max(0.0, (n - self.level) / self.per_second))

    def checkpoint(self) -> TokenBucket:
        return replace(self)


def argument_lists(expressions: list[str]) -> Iterator[list[str]]:
    """Parameter lists of argument expressions: ``--a=(x|y)``, ``--n=(start#step#count)``, ``&`` or space, ``|``, and
    ``--include=file`` whose lines are alternatives.  Of an argument given twice the first counts.
    """

    def values(arg: str) -> list[list[str]]:
        name, sep, value = arg.partition("=")
        if not arg.startswith("--") or not sep:
            raise ValueError(f"not an argument: {arg!r}")
        if m := re.fullmatch(r"\((-?\d+)#(-?\d+)#(\d+)\)", value):
            start, step, count = map(int, m.groups())
            options = [str(start + k * step) for k in range(count)]
        elif m := re.fullmatch(r"\((.*)\)", value):
            options = [x.strip() for x in m[1].split("|")]
        else:
            options = [value]
        if name == "--include":
            lines = [x.strip() for o in options for x in Path(o).read_text().splitlines()]
            return [x for line in lines if line and line[0] != "#" for x in expression(line)]
        return [[f"{name}={o}"] for o in options]

    def expression(text: str) -> list[list[str]]:
        alternatives = re.split(r"\|(?![^(]*\))", text)
        out = []
        for alternative in alternatives:
            args = [a for a in re.split(r"[&\s]+(?![^(]*\))", alternative.strip()) if a]
            out += [reduce(list.__add__, combo, []) for combo in itertools.product(*map(values, args))]
        return out

    for combo in itertools.product(*map(expression, expressions)):
        first: dict[str, str] = {}
        for arg in itertools.chain.from_iterable(combo):
            first.setdefault(arg.partition("=")[0], arg)
        yield list(first.values())
