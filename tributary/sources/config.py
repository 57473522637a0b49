"""Configuration: a tree of dataclasses read from JSON or YAML."""

from __future__ import annotations

import dataclasses
import json
import re
from dataclasses import dataclass, field
from datetime import timedelta
from pathlib import Path
from typing import Any, get_type_hints

_UNITS = {"ns": 1e-9, "us": 1e-6, "µs": 1e-6, "ms": 1e-3, "s": 1.0, "m": 60.0, "h": 3600.0}
_PART = re.compile(r"([0-9.]+)(ns|us|µs|ms|s|m|h)")


class ConfigError(ValueError):
    pass


def duration(value: Any) -> timedelta:
    """A timedelta from text such as '1m30s', integer nanoseconds, or a timedelta."""
    if isinstance(value, timedelta):
        return value
    if isinstance(value, int) and not isinstance(value, bool):
        return timedelta(microseconds=value / 1000)
    text = str(value).strip()
    if not text or _PART.sub("", text):
        raise ConfigError(f"not a duration: {value!r}")
    return timedelta(seconds=sum(float(n) * _UNITS[u] for n, u in _PART.findall(text)))


def seconds(n: float) -> Any:
    return field(default_factory=lambda: timedelta(seconds=n))


@dataclass
class ConnectionConfig:
    uri: str = ""
    database: str = ""
    collection: str = ""
    username: str = ""
    password: str = ""
    max_pool_size: int = 100
    min_pool_size: int = 5
    max_idle_time_ms: int = 300_000
    connect_timeout_ms: int = 30_000
    server_selection_timeout_ms: int = 60_000
    socket_timeout_ms: int = 120_000


@dataclass
class MetricConfig:
    port: int = 8080


@dataclass
class LoggerConfig:
    log_level: str = "info"


@dataclass
class CheckpointConfig:
    type: str = "auto"
    token_save_interval: timedelta = seconds(10)
    save_timeout: timedelta = seconds(10)
    bootstrap_save_interval: timedelta = seconds(10)
    change_stream_save_count: int = 500
    bootstrap_save_count: int = 2500
    bootstrap_query_batch_size: int = 2500
    bootstrap_slice_rows: int = 10_000_000
    idle_heartbeat_interval: timedelta = seconds(180)
    max_idle_time: timedelta = seconds(900)


@dataclass
class PartitionConfig:
    heartbeat_interval: timedelta = seconds(10)
    worker_timeout: timedelta = seconds(90)
    rebalance_check_interval: timedelta = seconds(10)
    workers_collection: str = "workers"
    partitions_collection: str = "partition_assignments"
    total_partition: int = 15
    consumer_group: str = ""


@dataclass
class Config:
    connection: ConnectionConfig = field(default_factory=ConnectionConfig)
    metric: MetricConfig = field(default_factory=MetricConfig)
    logger: LoggerConfig = field(default_factory=LoggerConfig)
    checkpoint: CheckpointConfig = field(default_factory=CheckpointConfig)
    partition: PartitionConfig = field(default_factory=PartitionConfig)
    graceful_shutdown_timeout: timedelta = seconds(10)
    startup_delay: timedelta = seconds(0)

    def validate(self) -> Config:
        c, p, k = self.connection, self.partition, self.checkpoint
        for name, value in (("connection.uri", c.uri), ("connection.database", c.database), ("connection.collection", c.collection), ("partition.consumer_group", p.consumer_group)):
            if not value.strip():
                raise ConfigError(f"{name} is required")
        if bool(c.username) != bool(c.password):
            raise ConfigError("username and password go together")
        if c.min_pool_size > c.max_pool_size:
            raise ConfigError("min_pool_size is above max_pool_size")
        if k.type not in ("auto", "manual"):
            raise ConfigError("checkpoint.type is auto or manual")
        for name in ("change_stream_save_count", "bootstrap_save_count", "bootstrap_query_batch_size", "bootstrap_slice_rows"):
            if getattr(k, name) <= 0:
                raise ConfigError(f"checkpoint.{name} must be positive")
        if p.total_partition <= 0:
            raise ConfigError("partition.total_partition must be positive")
        for part in (self, k, p):
            for f in dataclasses.fields(part):
                value = getattr(part, f.name)
                if isinstance(value, timedelta) and value < timedelta(0):
                    raise ConfigError(f"{f.name} must not be negative")
        return self

    def masked(self) -> Config:
        """A copy to print, without the password."""
        if not self.connection.password:
            return self
        return dataclasses.replace(self, connection=dataclasses.replace(self.connection, password="***"))


#: Other spellings of keys.
_ALIASES = {"tokensavetimeout": "savetimeout", "maxidletimems": "maxidletimems"}


def _plain(key: str) -> str:
    flat = re.sub(r"[^a-z0-9]", "", key.lower())
    return _ALIASES.get(flat, flat)


def _build(kind: type, tree: dict[str, Any]) -> Any:
    hints = get_type_hints(kind)
    known = {_plain(f.name): f.name for f in dataclasses.fields(kind)}
    values = {}
    for key, value in (tree or {}).items():
        name = known.get(_plain(key))
        if name is None or value is None:
            continue
        want = hints[name]
        values[name] = _build(want, value) if dataclasses.is_dataclass(want) else duration(value) if want is timedelta else want(value)
    return kind(**values)


def from_tree(tree: dict[str, Any]) -> Config:
    """From a parsed file; a lone root key around the sections is skipped."""
    sections = {_plain(f.name) for f in dataclasses.fields(Config)}
    if len(tree) == 1:
        (key, inner), *_ = tree.items()
        if _plain(key) not in sections and isinstance(inner, dict):
            tree = inner
    return _build(Config, tree)


def load(path: str | Path) -> Config:
    text = Path(path).read_text()
    suffix = Path(path).suffix.lower()
    if suffix == ".json":
        return from_tree(json.loads(text))
    if suffix in (".yml", ".yaml"):
        import yaml

        return from_tree(yaml.safe_load(text) or {})
    raise ConfigError(f"unknown configuration format: {suffix or path}")
