"""Counts of a run: observed while the plan runs, no pass of their own; of batches and of streams."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Drifts are the latest, as a gauge is; starts the least; everything else adds up.
LATEST, LEAST, MOST = ("drift_ms",), ("start_ms",), ("end_ms", "input_lag_ms")


def _now() -> Column:
    return F.unix_millis(F.current_timestamp())


def flow_counts() -> list[Column]:
    """Of flows: how many, how many without an exporter, which are dropped, and how far the latest end is behind now."""
    return [
        F.count(F.lit(1)).alias("count"), F.sum(F.col("node_id").isNull().cast("long")).alias("missing_fields"),
        F.min(_now() - F.col("last_switched")).alias("drift_ms"), *probe_counts(),
    ]


def document_counts() -> list[Column]:
    """Of documents: how many, and how far the latest is behind now."""
    return [F.count(F.lit(1)).alias("count"), F.min(_now() - F.col("@timestamp")).alias("drift_ms"), *probe_counts()]


def probe_counts() -> list[Column]:
    """First and last processing time; with a count they give a rate."""
    return [F.min(_now()).alias("start_ms"), F.max(_now()).alias("end_ms")]


@dataclass
class Snapshot:
    count: int
    start_ms: int
    end_ms: int

    @property
    def rate(self) -> float:
        """Rows a second."""
        return 0.0 if self.end_ms == self.start_ms else self.count / (self.end_ms - self.start_ms) * 1000


class Metrics(StreamingQueryListener):
    """Totals by observation name, of streams by listening and of batches by ``observe``."""

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = defaultdict(dict)
        self._batches: list[tuple[str, Observation]] = []

    def add(self, name: str, values: dict[str, int | None]) -> None:
        own = self.totals[name]
        for key, value in values.items():
            if value is not None:
                old = own.get(key)
                best = value if old is None or key in LATEST else min(old, value) if key in LEAST else max(old, value) if key in MOST else old + value
                own[key] = best

    def observe(self, rows: DataFrame, name: str, counts: list[Column]) -> DataFrame:
        """``rows`` observed under ``name``: a stream through this listener, a batch when ``collect`` is called after it ran."""
        if rows.isStreaming:
            return rows.observe(name, *counts)
        seen = Observation()
        self._batches.append((name, seen))
        return rows.observe(seen, *counts)

    def collect(self) -> dict[str, dict[str, int]]:
        """Totals, with those of the batches that ran since; a batch that didn't run has none."""
        for name, seen in self._batches:
            if seen._jo is not None and seen._jo.future().isCompleted():
                self.add(name, seen.get)
        self._batches.clear()
        return dict(self.totals)

    def snapshot(self, name: str) -> Snapshot:
        own = self.totals.get(name, {})
        return Snapshot(own.get("count", 0), own.get("start_ms", 0), own.get("end_ms", 0))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        for name, row in event.progress.observedMetrics.items():
            self.add(name, row.asDict())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
