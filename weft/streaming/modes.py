"""Streaming runs of the summary plan.

``final``: one row a window and key, once the watermark has passed.  ``triggered``: panes on time, and early and late
ones after delays, each with what came since the pane before.  ``panes``: every micro-batch reports what it saw, without
keyed state.  Consumers add up panes.  The groupings are computed by the batch plan inside ``foreachBatch``, since
rankings are not allowed on streams.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.flows import conversation_rows, dispatch, keyed, prorate, summed
from ..operators.lattice import GROUPINGS, VALUES, summarize
from ..options import Options
from ..schema import CONVERSATION, INTERFACE, WINDOW
from ..sources.flows import event_time
from ..sources.sinks import path_exists
from .state import triggered

Sink = Callable[[DataFrame, int], None]


def watermark_delay_ms(options: Options, lossless: bool = True) -> int:
    """How far the watermark trails: long flows reach back by their length, ranges end up to a window ahead."""
    back = options.max_flow_ms if lossless else options.allowed_lateness_ms
    return options.max_input_delay_ms + back + options.window_ms


def final_sums(flows: DataFrame, options: Options = Options(), *, cap_now: bool = False, names: tuple[str, ...] = tuple(GROUPINGS)) -> DataFrame:  # noqa: B008
    """Sums of a stream by what these groupings tell apart, each window once when it is complete (append mode).

    State holds a row for each of them: for all groupings a conversation and DSCP, for totals by interface an interface.
    Columns that no grouping needs are null.
    """
    needed, named = {c for n in names for c in GROUPINGS[n].keys}, any("host" in GROUPINGS[n].dims for n in names)
    needed |= {"larger_address"} if named else set()
    rows = keyed(prorate(dispatch(flows, options)))
    at = F.timestamp_millis(F.col("range_end"))
    rows = rows.withColumn("range_end_ts", F.least(at, F.current_timestamp()) if cap_now else at)
    rows = rows.withWatermark("range_end_ts", f"{watermark_delay_ms(options)} milliseconds")
    columns, kinds = ("dscp", *CONVERSATION), dict(rows.dtypes)
    sums = summed(rows, ("range_end_ts", *WINDOW, *INTERFACE, *(c for c in columns if c in needed)), named)
    sums = sums.withColumns({c: F.lit(None).cast(kinds[c]) for c in columns if c not in needed})
    return sums.select(*WINDOW, *INTERFACE, *columns, *VALUES)


def run_final(flows: DataFrame, sink: Sink, options: Options = Options(), *, cap_now: bool = False, names: tuple[str, ...] = tuple(GROUPINGS)) -> DataStreamWriter:  # noqa: B008
    """All rows of a window come in one micro-batch, so rankings there are exact.  Later rows are dropped."""

    def emit(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            sink(summarize(batch, options.top_k, names), batch_id)
        finally:
            batch.unpersist()

    return final_sums(flows, options, cap_now=cap_now, names=names).writeStream.outputMode("append").foreachBatch(emit)


def pane_sums(flows: DataFrame, options: Options = Options()) -> DataFrame:  # noqa: B008
    """Conversation sums of a stream in panes: ``pane`` is EARLY, ON_TIME or LATE, ``number`` counts those of a key.

    The watermark trails the latest end of a flow, capped at now, by the input delay.
    """
    timed = event_time(flows).withWatermark("event_time", f"{options.max_input_delay_ms} milliseconds")
    rows = keyed(prorate(dispatch(timed, options)), "event_time")
    return triggered(rows, options.early_delay_ms, options.late_delay_ms, options.allowed_lateness_ms)


def run_triggered(flows: DataFrame, sink: Sink, options: Options = Options()) -> DataStreamWriter:  # noqa: B008
    """Rankings are among the rows of a micro-batch that fire for the same window and kind of pane."""

    def emit(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for pane in ("EARLY", "ON_TIME", "LATE"):
                rows = batch.where(F.col("pane") == pane)
                if rows.take(1):
                    sink(summarize(rows.drop("pane", "number"), options.top_k).withColumn("pane", F.lit(pane)), batch_id)
        finally:
            batch.unpersist()

    return pane_sums(flows, options).writeStream.outputMode("append").foreachBatch(emit)


def run_panes(flows: DataFrame, sink: Sink, options: Options = Options(), floor_path: str | None = None) -> DataStreamWriter:  # noqa: B008
    """Discarding panes: each micro-batch's own sums and top k; flows beyond the allowed lateness are dropped.

    The lateness is judged against the latest end seen in earlier micro-batches.  That end is kept in a table at
    ``floor_path``, for a restarted run to go on with; without a path a restarted run starts anew.
    """
    spark = flows.sparkSession
    latest: dict[int, int | None] = {}

    def before(batch_id: int) -> int | None:
        if latest or not floor_path or not path_exists(spark, floor_path):
            return latest.get(batch_id - 1)
        return spark.read.schema("seen bigint, batch bigint").parquet(floor_path).where(F.col("batch") < batch_id).agg(F.max("seen")).first()[0]

    def emit(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            old = before(batch_id)
            floor = None if old is None else old - options.max_input_delay_ms - options.allowed_lateness_ms
            rows = batch if floor is None else batch.where(F.col("last_switched") + options.window_ms > floor)
            sink(summarize(conversation_rows(rows, options), options.top_k).withColumn("pane", F.lit(batch_id)), batch_id)
            seen = batch.agg(F.max(F.least("last_switched", F.unix_millis(F.current_timestamp())))).first()[0]
            latest.clear()
            latest[batch_id] = max((x for x in (old, seen) if x is not None), default=None)
            if floor_path and latest[batch_id] is not None:
                kept = spark.createDataFrame([(latest[batch_id], batch_id)], "seen bigint, batch bigint")
                kept.coalesce(1).write.mode("overwrite").parquet(f"{floor_path}/at={batch_id % 2}")  # the batch before stays
        finally:
            batch.unpersist()

    return flows.writeStream.outputMode("append").foreachBatch(emit)


def drain(query: StreamingQuery, seconds: float = 1_800) -> None:
    """Wait until a query has taken the input it found and its keyed state has given out all it held, then stop it."""
    end = time.monotonic() + seconds
    try:
        while time.monotonic() < end:
            if query.exception():
                raise query.exception()
            seen = query.lastProgress
            # the first micro-batch takes the input
            if seen and seen["batchId"] > 0 and not seen["numInputRows"] and not any(op["numRowsTotal"] for op in seen["stateOperators"]):
                return
            time.sleep(0.2)
        raise TimeoutError("the stream still holds state")
    finally:
        query.stop()
