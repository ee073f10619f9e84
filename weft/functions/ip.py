"""IP addresses, ranges and range lists, and native range tests."""

from __future__ import annotations

import bisect
import ipaddress
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Address = ipaddress.IPv4Address | ipaddress.IPv6Address


def sort_key(address: Address) -> tuple[int, int]:
    """All IPv4 addresses come before all IPv6 addresses."""
    return (address.version, int(address))


@dataclass(frozen=True)
class IPRange:
    begin: Address
    end: Address

    def __post_init__(self):
        if self.begin.version != self.end.version:
            raise ValueError(f"mixed address families: {self.begin}-{self.end}")
        if self.begin > self.end:
            raise ValueError(f"begin is larger than end: {self.begin}-{self.end}")

    @property
    def size(self) -> int:
        return int(self.end) - int(self.begin) + 1

    def __contains__(self, other: Address | IPRange) -> bool:
        lo, hi = (other.begin, other.end) if isinstance(other, IPRange) else (other, other)
        return lo.version == self.begin.version and self.begin <= lo and hi <= self.end

    def __iter__(self) -> Iterator[Address]:
        kind = type(self.begin)
        return (kind(n) for n in range(int(self.begin), int(self.end) + 1))

    def overlaps(self, other: IPRange) -> bool:
        return sort_key(self.begin) <= sort_key(other.end) and sort_key(other.begin) <= sort_key(self.end)

    def comes_before(self, other: IPRange) -> bool:
        return sort_key(self.end) < sort_key(other.begin)

    def comes_after(self, other: IPRange) -> bool:
        return other.comes_before(self)

    def adjoins(self, other: IPRange) -> bool:
        same = self.begin.version == other.begin.version
        return same and (int(self.end) + 1 == int(other.begin) or int(other.end) + 1 == int(self.begin))

    def combine(self, other: IPRange) -> IPRange:
        if not (self.overlaps(other) or self.adjoins(other)):
            raise ValueError(f"{self} and {other} neither overlap nor adjoin")
        return IPRange(min(self.begin, other.begin), max(self.end, other.end))

    def remove(self, other: IPRange) -> list[IPRange]:
        """What is left of this range without the other."""
        if not self.overlaps(other):
            return [self]
        kind, out = type(self.begin), []
        if self.begin < other.begin:
            out.append(IPRange(self.begin, kind(int(other.begin) - 1)))
        if other.end < self.end:
            out.append(IPRange(kind(int(other.end) + 1), self.end))
        return out

    def __str__(self) -> str:
        return f"{self.begin}-{self.end}"


def split_list(text: str | None, by: str = ",") -> list[str]:
    return [part.strip() for part in (text or "").split(by) if part.strip()]


def parse_range(text: str) -> IPRange:
    """An address, a range a-b, or a CIDR block."""
    parts = split_list(text, "-")
    if len(parts) > 2:
        raise ValueError(f"a range has two ends: {text!r}")
    if len(parts) == 2:
        if any("/" in p for p in parts):
            raise ValueError(f"a range can't contain CIDR notation: {text!r}")
        try:
            return IPRange(*map(ipaddress.ip_address, parts))
        except ValueError as e:
            raise ValueError(f"not a range of addresses: {text!r}: {e}") from None
    try:
        if "/" in text:
            net = ipaddress.ip_network(text, strict=False)
            return IPRange(net[0], net[-1])
        one = ipaddress.ip_address(text)
        return IPRange(one, one)
    except ValueError as e:
        raise ValueError(f"not an address: {text!r}: {e}") from None


def parse_host_filter(text: str | None) -> list[IPRange]:
    """A comma-separated list of addresses, ranges and CIDR blocks; blank gives none."""
    return [parse_range(part) for part in split_list(text)]


def merged(ranges: list[IPRange]) -> list[IPRange]:
    """The same addresses as few, ordered ranges."""
    out: list[IPRange] = []
    for r in sorted(ranges, key=lambda r: sort_key(r.begin)):
        if out and (out[-1].overlaps(r) or out[-1].adjoins(r)):
            out[-1] = out[-1].combine(r)
        else:
            out.append(r)
    return out


def ipv4_number(address: Column) -> Column:
    """Dotted IPv4 text to a number; null for anything else."""
    ok = address.rlike(r"^((25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(25[0-5]|2[0-4]\d|1?\d?\d)$")
    parts = F.split(address, r"\.")
    number = F.lit(0).cast("bigint")
    for k in range(4):
        number = number * 256 + F.try_element_at(parts, F.lit(k + 1)).cast("bigint")
    return F.when(ok, number)


def _within(number: Column, ranges: list[IPRange]) -> Column:
    """Whether a number lies in one of ordered, disjoint ranges: a search tree of comparisons, so a long list is few steps."""
    if len(ranges) <= 2:
        hit = F.lit(False)
        for r in ranges:
            hit = hit | number.between(int(r.begin), int(r.end))
        return hit
    half = len(ranges) // 2
    return F.when(number < int(ranges[half].begin), _within(number, ranges[:half])).otherwise(_within(number, ranges[half:]))


def in_ranges(address: Column, ranges: list[IPRange]) -> Column:
    """Whether the text is an address in one of the ranges; empty and malformed texts are not.

    IPv4 is plain arithmetic; only a filter with IPv6 ranges adds an Arrow function, for texts with a colon, which tests
    each different text once.
    """
    number = ipv4_number(address)
    hit = F.coalesce(_within(number, merged([r for r in ranges if r.begin.version == 4])), F.lit(False))
    wide = merged([r for r in ranges if r.begin.version == 6])
    if wide:
        begins = [int(r.begin) for r in wide]

        def test(text: str) -> bool:
            try:
                a = ipaddress.IPv6Address(text)
            except ValueError:
                return False
            k = bisect.bisect_right(begins, int(a)) - 1
            return k >= 0 and a in wide[k]

        @F.pandas_udf("boolean")
        def in_wide(texts: pd.Series) -> pd.Series:
            found = {t: test(t) for t in texts.dropna().unique()}
            return texts.map(found).fillna(False).astype(bool)

        hit = F.when(address.contains(":"), in_wide(address)).otherwise(hit)
    return hit
