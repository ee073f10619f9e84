"""Per-node shifted tumbling windows as column arithmetic on epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the multiplier of the 32-bit integer mix that spreads nodes over a window.
MIX = -1640531527


def node_shift(node: Column, window_ms: int) -> Column:
    """Offset of a node's windows: |mix32(node)| mod size."""
    h = (F.coalesce(node, F.lit(0)).cast("bigint") * F.lit(MIX)).bitwiseAND(F.lit(0xFFFFFFFF))
    h = h.bitwiseXOR(F.shiftrightunsigned(h, 16))
    signed = F.when(h >= 1 << 31, h - (1 << 32)).otherwise(h)
    return F.abs(signed) % window_ms


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def window_number(ts: Column, shift: Column, window_ms: int) -> Column:
    return _div(ts - shift, window_ms)


def window_start(ts: Column, shift: Column, window_ms: int) -> Column:
    return ts - (ts - shift) % window_ms


def start_of_number(number: Column, shift: Column, window_ms: int) -> Column:
    return shift + number * window_ms
