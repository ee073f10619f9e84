"""An unbounded source of synthetic flows that resumes from its offset.

The source gives indexes; flows are column expressions over them (see ``synthetic``).  An offset is the next index, so a
restarted query goes on where its checkpoint says.  The rate limit is a function of the clock alone, from a given start:
a reader needs no memory for it, and after a pause it catches up.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .synthetic import FlowConfig, flows_of


class Stripe(InputPartition):
    def __init__(self, first: int, end: int, step: int):
        self.first, self.end, self.step = first, end, step


class Indexes(DataSourceStreamReader):
    """Indexes below ``flows`` (no end if negative), ``perSecond`` of them from ``start`` (epoch seconds) on; any if 0."""

    def __init__(self, options: dict[str, str]):
        lower = {k.lower(): v for k, v in options.items()}
        self.n, self.rate = int(lower.get("flows", -1)), float(lower.get("persecond", 1000))
        self.start, self.splits, self.clock = float(lower.get("start", "nan")), int(lower.get("splits", 8)), time.time
        if self.rate and self.start != self.start or not self.rate and self.n < 0:
            raise ValueError("a rate needs a start, and a source without a rate an end")

    def initialOffset(self) -> dict:  # noqa: N802
        return {"index": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        """The index that the rate and the end allow by now."""
        allowed = max(0, int((self.clock() - self.start) * self.rate)) if self.rate else self.n
        return {"index": min(allowed, self.n) if self.n >= 0 else allowed}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Stripes: together they are all indexes from start to end."""
        return [Stripe(start["index"] + k, end["index"], self.splits) for k in range(min(self.splits, end["index"] - start["index"]))]

    def read(self, partition: Stripe) -> Iterator[tuple]:
        for i in range(partition.first, partition.end, partition.step):
            yield (i,)

    def commit(self, end: dict) -> None:
        pass


class SyntheticFlows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "weft_synthetic_flows"

    def schema(self) -> str:
        return "idx bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return Indexes(dict(self.options))

    @staticmethod
    def flows(indexes: DataFrame, config: FlowConfig = FlowConfig(), *, ends: Column | None = None) -> DataFrame:  # noqa: B008
        return flows_of(indexes, config, ends=ends)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SyntheticFlows)
