"""The public API: a connector that delivers a collection and its changes to a listener."""

from __future__ import annotations

import threading
import time
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

from tributary.functions.names import control_table, worker_id
from tributary.sources import config as configs
from tributary.sources.change_source import ChangeSource
from tributary.sources.config import Config
from tributary.sources.control import ControlStore, FileControlStore
from tributary.streaming.group import Group
from tributary.streaming.logs import get_logger
from tributary.streaming.metrics import Metrics, MetricServer
from tributary.streaming.progress import Progress
from tributary.streaming.runtime import Listener, PartitionEventHandler, Runtime


class Connector:
    """Snapshot, stream, checkpoints and group membership of one worker.

    ``folder`` holds the control tables and Spark's stream state; all workers of
    a group share it.
    """

    def __init__(self, spark: SparkSession, cfg: Config, listener: Listener, source: ChangeSource, folder: str, store: ControlStore | None = None, on_error: str = "fail", document: str | None = None, me: str | None = None):
        cfg.validate()
        self.spark, self.cfg, self.listener, self.source, self.folder = spark, cfg, listener, source, folder.rstrip("/")
        self.log = get_logger(cfg.logger.log_level)
        self.log.info("configuration: %s", cfg.masked())
        self.store = store or FileControlStore(Path(self.folder.removeprefix("file://")) / "control")
        self.metrics = Metrics()
        self.me = me or worker_id()
        self.group = Group(self.store, cfg.partition, self.me, self.metrics)
        self.progress = Progress(self.store, cfg, self.metrics)
        self.handler = PartitionEventHandler()
        self.on_error, self.document = on_error, document
        self._starting: list[int] = []
        self.runtime = self._runtime()
        self.server: MetricServer | None = None
        self._changed = threading.Event()
        self._closed = threading.Event()

    @classmethod
    def from_file(cls, spark: SparkSession, path: str, listener: Listener, source: ChangeSource, folder: str, **kwargs: object) -> Connector:
        return cls(spark, configs.load(path), listener, source, folder, **kwargs)

    def _runtime(self) -> Runtime:
        runtime = Runtime(self.spark, self.cfg, self.source, self.progress, self.listener, self.metrics, self.group.is_mine, self.on_error, self.document)
        runtime.on_started = self._started
        return runtime

    def set_event_handler(self, handler: PartitionEventHandler) -> None:
        self.handler = handler

    def start(self, available_now: bool = False) -> None:
        """Run until close(), or with ``available_now`` until the log's present end."""
        self.source.check()
        self.group.guard_total()
        self.group.register()
        if self.server is None and not available_now:
            self.server = MetricServer(self.metrics, self.cfg.metric.port)
        if self.cfg.startup_delay.total_seconds():
            time.sleep(self.cfg.startup_delay.total_seconds())
        owned = self.group.acquire()
        self._begin(owned)
        self.group.record(owned)
        if available_now:
            self.runtime.follow(owned, self._state, True, tries=3)
            self._settle(",".join(map(str, sorted(owned))))
            return
        self.group.run(self._reconcile)
        while not self._closed.is_set():
            self._changed.clear()
            owned = list(self.group.owned)
            if owned:
                self.runtime.follow(owned, self._state)
                self._settle(",".join(map(str, sorted(owned))))
            if not self._closed.is_set():
                self._changed.wait(1)
                if self.runtime.stopping.is_set():
                    self.runtime = self._runtime()

    @property
    def _states(self) -> str:
        return control_table(f"{self.cfg.connection.collection}_streams", self.cfg.partition.consumer_group)

    def _tokens(self) -> dict[str, int | None]:
        starts = {p: self.progress.start(p) for p in self.group.owned}
        return {str(p): at if how == "resume_token" else None for p, (how, at) in starts.items()}

    def _state(self) -> str:
        """The folder of Spark's stream state for the owned partitions.

        Tokens, not Spark's offsets, say where a stream starts. The state of the
        last stream over the same partitions, which knows the files that are
        done, is taken again if that stream had saved all it delivered, and no
        partition has gone back since; else a new one is begun.
        """
        name, tokens = ",".join(map(str, sorted(self.group.owned))), self._tokens()
        last = self.store.read(self._states).get(name)
        again = last and last["settled"] and all(t is not None and t >= last["tokens"][p] for p, t in tokens.items())
        path = last["path"] if again else f"{self.folder}/streams/{uuid.uuid4().hex}"
        self.store.update(self._states, lambda rows: rows.__setitem__(name, {"path": path, "settled": False, "tokens": {}}))
        if last and not again:
            folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(last["path"])
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        return path

    def _settle(self, name: str) -> None:
        """Let the next stream over the same partitions go on from this one's state."""
        tokens = {p: t for p, t in self._tokens().items() if t is not None}
        if self.runtime.settled and ",".join(sorted(tokens, key=int)) == name:
            self.store.update(self._states, lambda rows: rows.get(name, {}).update(settled=True, tokens=tokens))

    def _begin(self, partitions: list[int]) -> None:
        for p in partitions:
            self.handler.before_partition_start(p)
        self._starting += partitions

    def _started(self) -> None:
        starting, self._starting = self._starting, []
        for p in starting:
            self.handler.after_partition_start(p)

    def _reconcile(self, wanted: list[int]) -> None:
        """Stop the stream around a change of partitions: hooks, drain, save, then start with the new set."""
        stop = [p for p in self.group.owned if p not in wanted]
        start = [p for p in wanted if p not in self.group.owned]
        if not stop and not start:
            return
        for p in stop:
            self.handler.before_partition_stop(p)
        self.runtime.stop()
        for p in stop:
            self.handler.after_partition_stop(p)
        self._begin(start)
        self.group.record(wanted)
        self.metrics.set("active_partition_count", len(wanted))
        self._changed.set()

    def commit(self) -> None:
        """Save what is acknowledged (manual mode)."""
        self.runtime.commit()

    def commit_bootstrap(self, partition: int) -> None:
        """Save the snapshot progress of one partition (manual mode)."""
        self.runtime.commit_bootstrap(partition)

    def close(self) -> None:
        """Stop once: drain, save, release the partitions, leave the group."""
        if self._closed.is_set():
            return
        self._closed.set()
        self.runtime.stop()
        self.group.stop()
        if self.server:
            self.server.close()
