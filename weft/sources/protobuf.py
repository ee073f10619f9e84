"""Flow records on the wire: a decoder and an encoder for the protobuf message, in Arrow batches."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Field numbers of the flow message that the summaries use, and how they are wrapped.
NUMBERS = {2: "num_bytes", 11: "delta_switched", 12: "first_switched", 13: "last_switched", 17: "input_snmp_ifindex", 18: "output_snmp_ifindex", 22: "protocol", 46: "dscp", 47: "ecn"}
TEXTS = {4: "dst_address", 5: "dst_hostname", 26: "src_address", 27: "src_hostname", 38: "application", 40: "location"}
DIRECTION, SAMPLING, EXPORTER, TIMESTAMP = 3, 24, 36, 1
DDL = (
    "timestamp bigint, node_id int, foreign_source string, foreign_id string, direction string, application string, location string, protocol int, "
    "src_address string, dst_address string, src_hostname string, dst_hostname string, dscp int, ecn int, input_snmp_ifindex int, "
    "output_snmp_ifindex int, first_switched bigint, delta_switched bigint, last_switched bigint, num_bytes bigint, sampling_interval double"
)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at
        if shift > 63:
            raise ValueError("varint too long")


def fields(data: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(number, wire type, value) of each field; anything malformed raises ValueError."""
    at = 0
    try:
        while at < len(data):
            tag, at = _varint(data, at)
            number, kind = tag >> 3, tag & 7
            if kind == 0:
                value, at = _varint(data, at)
            elif kind in (1, 5):
                n = 8 if kind == 1 else 4
                value, at = data[at : at + n], at + n
            elif kind == 2:
                n, at = _varint(data, at)
                value, at = data[at : at + n], at + n
            else:
                raise ValueError(f"wire type {kind}")
            if at > len(data) or number == 0:
                raise ValueError("truncated message")
            yield number, kind, value
    except IndexError:
        raise ValueError("truncated message") from None


def decode_flow(data: bytes) -> dict:
    """A flow record; absent wrappers are None, absent texts '', an absent direction INGRESS."""
    row = dict.fromkeys((f.split()[0] for f in DDL.split(", "))) | dict.fromkeys(TEXTS.values(), "")
    row |= {"direction": "INGRESS", "timestamp": 0, "src_hostname": "", "dst_hostname": ""}
    for number, _, value in fields(data):
        if number in TEXTS:
            row[TEXTS[number]] = value.decode()
        elif number in NUMBERS:
            row[NUMBERS[number]] = dict((n, v) for n, _, v in fields(value)).get(1, 0)
        elif number == SAMPLING:
            row["sampling_interval"] = struct.unpack("<d", dict((n, v) for n, _, v in fields(value)).get(1, bytes(8)))[0]
        elif number == DIRECTION:
            row["direction"] = ("INGRESS", "EGRESS")[value]
        elif number == TIMESTAMP:
            row["timestamp"] = value
        elif number == EXPORTER:
            node = {n: v for n, _, v in fields(value)}
            row |= {"foreign_source": node.get(1, b"").decode(), "foreign_id": node.get(2, b"").decode(), "node_id": node.get(3, 0)}
    return row


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def field(number: int, value: int | float | bytes | str) -> bytes:
    if isinstance(value, float):
        return varint(number << 3 | 1) + struct.pack("<d", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value & (1 << 64) - 1)
    value = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(value)) + value


def encode_flow(row: dict) -> bytes:
    """The message of a flow record, for tests and generators."""
    out = b""
    for number, name in NUMBERS.items():
        if row.get(name) is not None:
            out += field(number, field(1, row[name]) if row[name] else b"")
    for number, name in TEXTS.items():
        if row.get(name):
            out += field(number, row[name])
    if row.get("direction") == "EGRESS":
        out += field(DIRECTION, 1)
    if row.get("sampling_interval") is not None:
        out += field(SAMPLING, field(1, float(row["sampling_interval"])))
    if row.get("node_id") is not None:
        node = b"".join(field(n, row[c]) for n, c in ((1, "foreign_source"), (2, "foreign_id")) if row.get(c)) + field(3, row["node_id"])
        out += field(EXPORTER, node)
    return out


def decode_flows(raw: DataFrame) -> DataFrame:
    """Rows (value) of messages as flow columns; a malformed message fails the job."""
    names = [f.split()[0] for f in DDL.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
    types = [kinds[f.split()[1]] for f in DDL.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [decode_flow(v) for v in batch["value"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names)

    return raw.select("value").mapInArrow(run, DDL)
