"""Keyed state: triggered panes, pane accumulation, and indexes that keep samples of a series apart.

The processors run in processing time and read the watermark as they go, so one operator can wait for either.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..schema import CONVERSATION, INTERFACE, WINDOW

VALUES_DDL = "bytes_in bigint, bytes_out bigint, hostname string, hostname2 string, congestion boolean, non_ect boolean"
VALUES = tuple(x.split()[0] for x in VALUES_DDL.split(", "))
NOTHING = (0, 0, None, None, False, False)
POLL_MS, PATIENCE_MS, REST_MS = 1_000, 10_000, 300_000


def _poll(now: int, mark: int, wanted: int, most: int = REST_MS) -> int:
    """When to look again whether the watermark has come to ``wanted``: it may run faster than time, and 0 is none yet."""
    return now + (min(most, max(POLL_MS, wanted - mark)) if mark else POLL_MS)


def merged(a: tuple, b: tuple) -> tuple:
    """Bytes added, flags joined by or, host names the least that is not empty."""
    name = lambda x, y: min((v for v in (x, y) if v), default=None)
    return a[0] + b[0], a[1] + b[1], name(a[2], b[2]), name(a[3], b[3]), a[4] or b[4], a[5] or b[5]


class _Timed(StatefulProcessor):
    """A processor with one value and at most one pending timer a key; the value's last column is the timer, 0 for none."""

    ddl = ""
    names: list[str] | None = None  # of what it emits

    def _row(self, *values) -> Row:
        return Row(**dict(zip(self.names, values, strict=True))) if self.names else Row(*values)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("value", f"{self.ddl}, timer bigint")

    def _load(self) -> tuple[tuple | None, int]:
        if not self.state.exists():
            return None, 0
        *value, timer = self.state.get()
        return tuple(value), timer

    def _store(self, value: tuple, timer: int, wanted: int) -> None:
        if timer != wanted:
            if timer:
                self.handle.deleteTimer(timer)
            if wanted:
                self.handle.registerTimer(wanted)
        self.state.update((*value, wanted))

    def _clear(self, timer: int) -> None:
        if timer:
            self.handle.deleteTimer(timer)
        self.state.clear()

    def close(self) -> None:
        pass


class PaneTrigger(_Timed):
    """Discarding panes of a window and key: early, on time and late.

    An early pane fires ``early_ms`` of processing time after the first row of a pane (never if 0), the pane on time when
    the watermark passes the window's end, a late pane ``late_ms`` after the first late row, and what is left fires when
    the allowed lateness is over, after which rows are dropped and the state is gone.  Panes without rows don't fire.
    """

    ddl = VALUES_DDL + ", filled boolean, fired boolean, number int, due bigint"

    def __init__(self, early_ms: int, late_ms: int, lateness_ms: int, end: int = 1):
        self.early_ms, self.late_ms, self.lateness_ms, self.end = early_ms, late_ms, lateness_ms, end

    def _step(self, key, value: tuple, timer: int, now: int, mark: int) -> Iterator[Row]:
        total, (filled, fired, number, due) = value[:6], value[6:]
        end, kind = key[self.end], None
        expired = mark >= end + self.lateness_ms
        if mark >= end and not fired:
            kind, fired = "ON_TIME", True
        elif filled and (expired or due and now >= due):
            kind = "LATE" if fired else "EARLY"
        if kind and filled:
            yield self._row(*key, *total, kind, number)
            total, filled, number, due = NOTHING, False, number + 1, 0
        if expired:
            self._clear(timer)
            return
        waits = [due] if filled and due else []
        waits.append(_poll(now, mark, end + self.lateness_ms) if fired else _poll(now, mark, end, PATIENCE_MS))
        self._store((*total, filled, fired, number, due), timer, min(waits))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now, mark = timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs()
        value, timer = self._load()
        if mark >= key[self.end] + self.lateness_ms and value is None:
            return  # too late
        value = value or (*NOTHING, False, False, 0, 0)
        total, (filled, fired, number, due) = value[:6], value[6:]
        if not filled:
            due = now + self.late_ms if fired else now + self.early_ms if self.early_ms else 0
        for r in rows:
            total = merged(total, tuple(r[c] for c in VALUES))
        yield from self._step(key, (*total, True, fired, number, due), timer, now, mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        value, timer = self._load()
        if value is not None and expiredTimerInfo.getExpiryTimeInMs() == timer:
            yield from self._step(key, value, 0, timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs())


class PaneAccumulator(_Timed):
    """Holds the first value of a key for a processing-time delay, merges what follows, and emits once when it ends.

    The value is emitted earlier if its window expires: if the watermark passes its end by the allowed lateness.
    """

    ddl = VALUES_DDL + ", due bigint"

    def __init__(self, delay_ms: int, lateness_ms: int, end: int):
        self.delay_ms, self.lateness_ms, self.end = delay_ms, lateness_ms, end

    def _step(self, key, value: tuple, timer: int, now: int, mark: int) -> Iterator[Row]:
        left = key[self.end] + self.lateness_ms - mark
        if now >= value[6] or left <= 0:
            self._clear(timer)
            yield self._row(*key, *value[:6])
        else:
            self._store(value, timer, min(value[6], _poll(now, mark, key[self.end] + self.lateness_ms)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now, mark = timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs()
        value, timer = self._load()
        total, due = (value[:6], value[6]) if value else (NOTHING, now + self.delay_ms)
        for r in rows:
            total = merged(total, tuple(r[c] for c in VALUES))
        yield from self._step(key, (*total, due), timer, now, mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        value, timer = self._load()
        if value is not None and expiredTimerInfo.getExpiryTimeInMs() == timer:
            yield from self._step(key, value, 0, timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs())


def _ddl(rows: DataFrame, columns: Iterable[str]) -> str:
    return ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)


def _with_state(rows: DataFrame, keys: tuple[str, ...], processor: StatefulProcessor, out: str) -> DataFrame:
    """Needs the RocksDB state store."""
    processor.names = [c.strip().split()[0].strip("`") for c in out.split(", ")]
    return rows.groupBy(*keys).transformWithState(statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode="ProcessingTime")


def triggered(rows: DataFrame, early_ms: int, late_ms: int, lateness_ms: int) -> DataFrame:
    """Streaming conversation rows with a watermark as panes: the sums with ``pane`` (EARLY, ON_TIME, LATE) and ``number``."""
    keys = (*WINDOW, *INTERFACE, "dscp", *CONVERSATION)
    return _with_state(rows, keys, PaneTrigger(early_ms, late_ms, lateness_ms), f"{_ddl(rows, keys)}, {VALUES_DDL}, pane string, number int")


def accumulate(rows: DataFrame, keys: tuple[str, ...], delay_ms: int, lateness_ms: int = 0, end: str = "range_end") -> DataFrame:
    """Streaming rows (keys, values) with the panes of ``delay_ms`` merged; ``end`` is the key with the window's end."""
    return _with_state(rows, keys, PaneAccumulator(delay_ms, lateness_ms, keys.index(end)), f"{_ddl(rows, keys)}, {VALUES_DDL}")


SERIES_OUT = "metric string, series string, ts_ms bigint, value double, pane int"


class SeriesIndexer(_Timed):
    """Gives each sample of a series the first index at which times only rise.

    The state is dropped when the watermark passes the newest time by the allowed lateness.
    """

    ddl = "slots array<bigint>"

    def __init__(self, lateness_ms: int):
        self.lateness_ms = lateness_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now, mark = timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs()
        value, timer = self._load()
        slots = list(value[0]) if value else []
        for r in rows:
            yield self._row(*key, r.ts_ms, r.value, next_index(slots, r.ts_ms))
        self._store((slots,), timer, _poll(now, mark, max(slots) + self.lateness_ms + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        value, timer = self._load()
        if value is not None and expiredTimerInfo.getExpiryTimeInMs() == timer:
            over, mark = max(value[0]) + self.lateness_ms + 1, timerValues.getCurrentWatermarkInMs()
            if mark < over:
                self._store(value, 0, _poll(timerValues.getCurrentProcessingTimeInMs(), mark, over))
            else:
                self._clear(0)
        return iter(())


class SeriesAccumulator(_Timed):
    """Adds up the values of a series that have the same time for a processing-time delay, then gives them indexes.

    What is left is emitted, and the state dropped, when the watermark passes the newest time by the allowed lateness.
    """

    ddl = "slots array<bigint>, ts array<bigint>, total array<double>, created array<bigint>"

    def __init__(self, delay_ms: int, lateness_ms: int):
        self.delay_ms, self.lateness_ms = delay_ms, lateness_ms

    def _step(self, key, heap: SeriesHeap, timer: int, now: int, mark: int) -> Iterator[Row]:
        newest = max([*heap.slots, *heap.held])
        over = mark >= newest + self.lateness_ms + 1
        for index, ts, value in heap.flush(now, 0 if over else self.delay_ms):
            yield self._row(*key, ts, value, index)
        if over:
            self._clear(timer)
            return
        held = sorted(heap.held.items())
        value = (heap.slots, [t for t, _ in held], [v for _, (v, _) in held], [c for _, (_, c) in held])
        waits = [_poll(now, mark, newest + self.lateness_ms + 1)]
        waits += [max(now + 1, t) for t in (heap.next_timer(self.delay_ms),) if t is not None]
        self._store(value, timer, min(waits))

    def _heap(self, value: tuple | None) -> SeriesHeap:
        heap = SeriesHeap()
        if value:
            heap.slots = list(value[0])
            heap.held = {t: (v, c) for t, v, c in zip(*value[1:], strict=True)}
        return heap

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        value, timer = self._load()
        heap = self._heap(value)
        for r in rows:
            heap.add(r.ts_ms, r.value, now)
        yield from self._step(key, heap, timer, now, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        value, timer = self._load()
        if value is not None and expiredTimerInfo.getExpiryTimeInMs() == timer:
            yield from self._step(key, self._heap(value), 0, timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs())


def indexed_stream(samples: DataFrame, delay_ms: int = 0, lateness_ms: int = 0) -> DataFrame:
    """Streaming samples with indexes as their label ``pane``, added up by time for ``delay_ms`` first unless 0.

    Their watermark, on a column of theirs, must be set.
    """
    bare = F.map_filter("labels", lambda k, _: k != "pane")
    keyed = samples.withColumn("series", F.to_json(bare)).select("metric", "series", "ts_ms", "value", *[c for c in samples.columns if c not in ("metric", "labels", "ts_ms", "value")])
    processor = SeriesAccumulator(delay_ms, lateness_ms) if delay_ms else SeriesIndexer(lateness_ms)
    out = _with_state(keyed, ("metric", "series"), processor, SERIES_OUT)
    labels = F.map_concat(F.from_json("series", "map<string,string>"), F.create_map(F.lit("pane"), F.col("pane").cast("string")))
    return out.select("metric", labels.alias("labels"), "ts_ms", "value")


def next_index(slots: list[int], ts: int) -> int:
    """The first slot whose time is before ts, which then holds ts; a new slot if there is none."""
    for i, held in enumerate(slots):
        if held < ts:
            slots[i] = ts
            return i
    slots.append(ts)
    return len(slots) - 1


def indexed(samples: DataFrame, series: list[str], ts: str = "ts_ms", arrival: str = "arrival") -> DataFrame:
    """Adds ``pane``: indexes in order of arrival, so that times only rise within a (series, index).

    Series are spread by hash and streamed in order through each task, which holds the slots of one series at a time.
    """
    ordered = samples.repartition(*series).sortWithinPartitions(*series, arrival)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in samples.schema) + ", pane int"

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, slots = None, []
        for batch in parts:
            keys = list(zip(*(batch[c].to_pylist() for c in series), strict=True))
            out = []
            for key, at in zip(keys, batch[ts].to_pylist(), strict=True):
                if key != current:
                    current, slots = key, []
                out.append(next_index(slots, at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], [*batch.schema.names, "pane"])

    return ordered.mapInArrow(run, ddl)


class SeriesHeap:
    """Values of one series by event time, merged until they are old enough; sorted by time before they get indexes."""

    def __init__(self):
        self.slots: list[int] = []
        self.held: dict[int, tuple[float, int]] = {}

    def add(self, ts: int, value: float, now: int) -> None:
        old, created = self.held.get(ts, (0.0, now))
        self.held[ts] = (old + value, created)

    def flush(self, now: int, delay: int) -> list[tuple[int, int, float]]:
        """(index, time, value) of what arrived at least ``delay`` ago, in order of time."""
        due = sorted(t for t, (_, created) in self.held.items() if created <= now - delay)
        return [(next_index(self.slots, t), t, self.held.pop(t)[0]) for t in due]

    def next_timer(self, delay: int) -> int | None:
        """When the oldest value becomes due."""
        return min((created + delay for _, created in self.held.values()), default=None)
