"""A worker's checkpoints: what is acknowledged, what is saved, when to save."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from typing import Any

from tributary.functions.names import checkpoint_id, checkpoint_table
from tributary.sources.config import Config
from tributary.sources.control import ControlStore, Rows
from tributary.streaming.backoff import FAST, retry
from tributary.streaming.metrics import Metrics


class Acks:
    """Delivered and acknowledged positions of one partition; the commit point is the end of the acknowledged prefix."""

    def __init__(self) -> None:
        self.open: dict[Any, None] = {}
        self.done: dict[Any, Any] = {}
        self.ready: tuple[Any, Any] | None = None
        self.pending = 0

    def deliver(self, position: Any) -> None:
        self.open[position] = None

    def ack(self, position: Any, mark: Any) -> None:
        if position not in self.open or position in self.done:
            return
        self.done[position] = mark
        for first in list(self.open):
            if first not in self.done:
                break
            del self.open[first]
            self.ready = (first, self.done.pop(first))
            self.pending += 1


class Progress:
    """Reads and writes the checkpoint table; partial writes keep what they don't touch."""

    def __init__(self, store: ControlStore, cfg: Config, metrics: Metrics, clock: Callable[[], float] = time.time):
        self.store, self.cfg, self.metrics, self.clock = store, cfg, metrics, clock
        self.table = checkpoint_table(cfg.connection.collection, cfg.partition.consumer_group)
        self.lock = threading.RLock()

    def _id(self, partition: int) -> str:
        return checkpoint_id(self.cfg.connection.database, self.cfg.connection.collection, partition)

    def read(self, partition: int) -> dict[str, Any]:
        return self.store.read(self.table).get(self._id(partition), {})

    def write(self, partition: int, upsert: bool = True, **values: Any) -> None:
        """Set fields; None clears one. Without ``upsert`` a missing row stays missing."""

        def change(rows: Rows) -> None:
            if not upsert and self._id(partition) not in rows:
                return
            row = rows.setdefault(self._id(partition), {})
            row |= values | {"partition_id": partition, "updated_at": self.clock()}

        began = self.clock()
        try:
            retry(lambda: self.store.update(self.table, change), FAST, within_s=self.cfg.checkpoint.save_timeout.total_seconds())
        except Exception:
            self.metrics.add("checkpoint_save_error_total")
            raise
        self.metrics.saved(self.clock() - began)

    def save_token(self, partition: int, token: int | None, cluster_time: tuple[int, int] | None) -> None:
        values: dict[str, Any] = {}
        if token is not None:
            values["resume_token"] = token
        if cluster_time is not None:
            values["last_cluster_time"] = list(cluster_time)
        if values:
            self.write(partition, is_bootstrapping=False, **values)

    def advance(self, partition: int, token: int | None, cluster_time: tuple[int, int]) -> None:
        """Move an idle partition on. By time alone, the old token goes, since it would win at the next start."""
        self.write(partition, resume_token=token, last_cluster_time=list(cluster_time))

    def save_bootstrap(self, partition: int, last_id: str) -> None:
        self.write(partition, bootstrap_last_id=last_id, is_bootstrapping=True)

    def begin_bootstrap(self, partition: int, mark: tuple[int | None, int, int]) -> tuple[int | None, int, int]:
        """Keep the first watermark through every retry: changes since then are replayed after the snapshot."""
        kept = self.read(partition).get("bootstrap_start")
        if kept is None:
            self.write(partition, bootstrap_start=list(mark), is_bootstrapping=True)
            return mark
        return tuple(kept)

    def finish_bootstrap(self, partition: int) -> None:
        """Clear the snapshot's progress and leave its first watermark as the place to stream from."""
        start = self.read(partition).get("bootstrap_start") or [-1, 0, 0]
        self.write(partition, bootstrap_last_id=None, bootstrap_start=None, is_bootstrapping=False, resume_token=start[0], last_cluster_time=start[1:])

    def reset(self, partition: int) -> None:
        """Forget everything, so that the partition starts with a new snapshot."""
        self.write(partition, upsert=False, resume_token=None, last_cluster_time=None, bootstrap_last_id=None, bootstrap_start=None, is_bootstrapping=False)

    def start(self, partition: int) -> tuple[str, Any]:
        """How the partition starts: ('bootstrap', last id), ('resume_token', token) or ('start_at_time', [t, i])."""
        row = self.read(partition)
        token, when = row.get("resume_token"), row.get("last_cluster_time")
        if when is not None and when[0] == 0 and when[1] == 0:
            when = None
        if row.get("is_bootstrapping") or row.get("bootstrap_last_id") is not None or (token is None and when is None):
            return "bootstrap", row.get("bootstrap_last_id")
        return ("resume_token", token) if token is not None else ("start_at_time", when)
