"""Options of the summary job, with the defaults of its command line."""

from __future__ import annotations

from dataclasses import dataclass, fields

from .functions.ip import parse_host_filter

INDEX_STRATEGIES = ("YEARLY", "MONTHLY", "DAILY", "HOURLY")


@dataclass(frozen=True)
class Options:
    window_ms: int = 60_000
    top_k: int = 10
    max_input_delay_ms: int = 120_000
    max_flow_ms: int = 900_000
    early_delay_ms: int = 0
    late_delay_ms: int = 60_000
    allowed_lateness_ms: int = 14_400_000
    accumulation_delay_ms: int = 0
    kafka_bootstrap: str = "localhost:9092"
    kafka_properties: str = ""
    flow_source_topic: str = "flows"
    flow_dest_topic: str = ""
    elastic_url: str = "http://localhost:9200"
    elastic_user: str = ""
    elastic_password: str = ""
    elastic_index: str = "netflow_agg"
    elastic_index_strategy: str = "MONTHLY"
    elastic_connect_timeout_ms: int = 30_000
    elastic_socket_timeout_ms: int = 30_000
    elastic_retry_count: int = 3
    elastic_retry_ms: int = 30_000
    remote_write_url: str = ""
    remote_write_org: str = ""
    remote_write_batch: int = 10_000
    remote_write_batch_bytes: int = 524_288
    remote_write_accumulation_ms: int = 0
    remote_write_hosts: str = ""

    def __post_init__(self):
        for f in fields(self):
            if f.type == "int" and getattr(self, f.name) < 0:
                raise ValueError(f"{f.name} must not be negative")
        for name in ("window_ms", "top_k", "max_flow_ms", "remote_write_batch"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be positive")
        if self.elastic_index_strategy not in INDEX_STRATEGIES:
            raise ValueError(f"elastic_index_strategy must be one of {INDEX_STRATEGIES}")
        parse_host_filter(self.remote_write_hosts)

    @classmethod
    def from_args(cls, args: list[str]) -> Options:
        """From --name=value arguments; unknown names are errors."""
        kinds, found = {f.name: f.type for f in fields(cls)}, {}
        for arg in args:
            name, sep, value = arg.removeprefix("--").partition("=")
            name = name.replace("-", "_")
            if not arg.startswith("--") or not sep or name not in kinds:
                raise ValueError(f"unknown argument {arg!r}")
            found[name] = int(value) if kinds[name] == "int" else value
        return cls(**found)

    @property
    def writes_elastic(self) -> bool:
        return bool(self.elastic_url)

    @property
    def writes_kafka(self) -> bool:
        return bool(self.flow_dest_topic)

    @property
    def writes_series(self) -> bool:
        return bool(self.remote_write_url)
