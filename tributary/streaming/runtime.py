"""The running stream of one worker: snapshot first, then the changes.

One scan serves all partitions: the snapshot is read once in key order, and
one streaming query follows the log; partition_id is a column of both. Each
micro-batch is delivered, acknowledged and folded into the checkpoints, so
delivery is at least once and in order within a partition.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tributary.functions.hashing import partition_of
from tributary.operators import changes as ops
from tributary.operators.checkpoints import latest_ack
from tributary.operators.feed import fill_updates, says_history_lost
from tributary.operators.snapshot import scan, synthetic_log
from tributary.sources.change_source import ChangeSource
from tributary.sources.config import Config
from tributary.streaming.backoff import DEFAULT, SLOW, STREAM, Backoff, retry
from tributary.streaming.logs import get_logger
from tributary.streaming.metrics import Metrics
from tributary.streaming.progress import Acks, Progress


#: Documents of a micro-batch that are looked up by a broadcast join; more are by a shuffle join.
LOOKED_UP = 100_000
#: Most parts in which a record listener's rows are fetched.
MOST_FETCHES = 10_000


class HistoryLost(RuntimeError):
    """The log no longer reaches back to a partition's checkpoint."""

    def __init__(self, partitions: list[int]):
        super().__init__(f"history lost for partitions {partitions}")
        self.partitions = partitions


@dataclass
class Delivery:
    """What a record listener gets: the message, its partition, and the call that acknowledges it."""

    message: Row
    partition_id: int
    is_bootstrap: bool
    ack: Callable[[], None]


#: A listener of records. One with the attribute ``batch`` gets (frame, batch id) instead, and its return acknowledges the batch.
Listener = Callable[..., None]


class PartitionEventHandler:
    """Hooks around a partition's stop and start; does nothing by default."""

    def before_partition_stop(self, partition: int) -> None: ...

    def after_partition_stop(self, partition: int) -> None: ...

    def before_partition_start(self, partition: int) -> None: ...

    def after_partition_start(self, partition: int) -> None: ...


class Runtime:
    def __init__(self, spark: SparkSession, cfg: Config, source: ChangeSource, progress: Progress, listener: Listener, metrics: Metrics, is_mine: Callable[[int], bool] = lambda p: True, on_error: str = "fail", document: str | None = None, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.time):
        if on_error not in ("fail", "skip"):
            raise ValueError("on_error is fail or skip")
        self.spark, self.cfg, self.source, self.progress, self.listener, self.metrics = spark, cfg, source, progress, listener, metrics
        self.is_mine, self.on_error, self.document, self.sleep, self.clock = is_mine, on_error, document, sleep, clock
        self.log = get_logger(cfg.logger.log_level)
        self.total = cfg.partition.total_partition
        self.active: set[int] = set()
        self.acks: dict[int, Acks] = {}
        self.snapshot_acks: dict[int, Acks] = {}
        self.on_started: Callable[[], None] = lambda: None
        self.stopping = threading.Event()
        self.drained = threading.Event()
        self.drained.set()
        self.lock = threading.RLock()
        self.query = None
        self.dead_letter_query = None
        #: (token, t, i) up to which the stream has read and delivered the log.
        self.read_to: tuple[int, int, int] | None = None
        self.last_event: dict[int, float] = {}
        self.last_save = self.last_idle_look = self.began = clock()
        self.last_bootstrap_save: dict[int, float] = {}

    # --- start state and snapshot ---------------------------------------

    def bootstrap(self, partitions: Iterable[int]) -> None:
        """Snapshot the partitions that need one, and leave them where streaming continues."""
        starts = {p: self.progress.start(p) for p in partitions if self.is_mine(p)}
        todo = {p: last for p, (how, last) in starts.items() if how == "bootstrap"}
        if not todo:
            return
        mark = self.low_watermark()
        for p in todo:
            self.progress.begin_bootstrap(p, mark)
        self.metrics.set("bootstrap_active", 1)
        try:
            retry(lambda: self._scan(self._snapshot_progress(todo)), SLOW, self.sleep)
        except BaseException:
            self.save_interrupted()
            raise
        finally:
            self.metrics.set("bootstrap_active", 0)
        if not self.stopping.is_set():
            for p in todo:
                self.commit_bootstrap(p)
                self.progress.finish_bootstrap(p)
                self.snapshot_acks.pop(p, None)

    def _snapshot_progress(self, partitions: Iterable[int]) -> dict[int, str | None]:
        """Where each partition's scan goes on: after what is saved. What was delivered beyond that comes again."""
        self.save_interrupted()
        for p in partitions:
            self.snapshot_acks.pop(p, None)
        return {p: self.progress.read(p).get("bootstrap_last_id") for p in partitions}

    def low_watermark(self) -> tuple[int | None, int, int]:
        """The log's end before the snapshot; by the local clock, without a token, if the log doesn't answer."""
        try:
            return retry(self.source.high_watermark, DEFAULT, self.sleep)
        except Exception as e:
            self.log.warning("no watermark from the log, taking the clock: %s", e)
            return None, min(max(int(self.clock()), 0), ops.MOST_SECONDS), 1

    def _scan(self, progress: dict[int, str | None]) -> None:
        """All partitions' rows in key order, each partition after its own last key.

        A batch listener gets key ranges of about ``bootstrap_slice_rows`` rows:
        the bounds reach the scan, so a range reads its own files and row
        groups. A record listener gets one sorted pass.
        """
        key, started = self.source.key, int(self.clock())
        rows = self.source.snapshot()
        document = self.document or next(c for c in rows.columns if c != key)
        kind = rows.schema[key].dataType
        native = {p: None if v is None else self.spark.range(1).select(F.lit(v).cast(kind)).first()[0] for p, v in progress.items()}
        after = None if None in native.values() else min(native.values())
        if after is not None:
            rows = rows.filter(F.col(key) > F.lit(after).cast(kind))
        mine = scan(rows, key, self.total, only=sorted(native))
        for p, v in native.items():
            if v is not None:
                mine = mine.filter((F.col("partition_id") != p) | (F.col(key) > F.lit(v).cast(kind)))
        batch = getattr(self.listener, "batch", False)
        for n, (low, high) in enumerate(self._ranges(rows, key) if batch else [(None, None)]):
            part = mine if low is None else mine.filter(F.col(key) > F.lit(low).cast(kind))
            part = part if high is None else part.filter(F.col(key) <= F.lit(high).cast(kind))
            log = synthetic_log(part, key, document, started)
            self._deliver(ops.to_messages(log, self.cfg.connection.database, self.cfg.connection.collection, self.total, bootstrap=True), n, bootstrap=True, order=[F.col("document_id").cast(kind)])

    def _ranges(self, rows: DataFrame, key: str) -> list[tuple[Any, Any]]:
        """Bounds (above, up to) of key ranges of about equal counts; the ends are open."""
        n = -(-rows.count() // self.cfg.checkpoint.bootstrap_slice_rows)
        if n <= 1:
            return [(None, None)]
        dealt = rows.select(key).repartitionByRange(n, key)
        ends = sorted(r[0] for r in dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.max(key).alias("end")).select("end").collect())
        return list(zip([None, *ends[:-1]], [*ends[:-1], None], strict=True))

    # --- stream ------------------------------------------------------------

    def check_history(self, partitions: Iterable[int]) -> None:
        """Raise if the log starts after what a partition needs next, by token or, for starts by time, by cluster time."""
        head = self.source.oldest_available()
        if head is None:
            return
        starts = {p: self.progress.start(p) for p in partitions}
        lost = [p for p, (how, at) in starts.items() if (how == "resume_token" and 0 <= at < head[0] - 1) or (how == "start_at_time" and tuple(at) < tuple(head[1:]))]
        if lost:
            raise HistoryLost(lost)

    def stream(self, partitions: Iterable[int], checkpoint: str, available_now: bool = False) -> None:
        """Follow the log for the partitions from their checkpoints until stop() (or the log's end)."""
        mine = sorted(p for p in partitions if self.is_mine(p))
        self.check_history(mine)
        starts = {p: self.progress.start(p) for p in mine}
        tokens = {p: s[1] for p, s in starts.items() if s[0] == "resume_token"}
        times = {p: s[1] for p, s in starts.items() if s[0] == "start_at_time"}
        after = min(tokens.values()) if len(tokens) == len(starts) and tokens else None
        wanted = F.lit(False)
        p = F.col("partition_id")
        for q, token in tokens.items():
            wanted = wanted | ((p == q) & (F.col("token") > token))
        for q, (t, i) in times.items():
            wanted = wanted | ((p == q) & ((F.col("t") > t) | ((F.col("t") == t) & (F.col("i") >= i))))
        end = F.max(F.struct("token", "t", "i")).alias("end")
        rows = ops.filter_operations(self.source.changes(after).observe("read", end))
        rows = rows.withColumn("partition_id", partition_of(F.col("doc_id"), self.total)).filter(wanted).drop("partition_id")
        messages = ops.to_messages(rows, self.cfg.connection.database, self.cfg.connection.collection, self.total)
        with self.lock:
            self.active, self.read_to = set(mine), None
            self.acks.clear()  # all that isn't saved is delivered again
        self.metrics.set("active_partition_count", len(mine))
        writer = messages.writeStream.foreachBatch(lambda df, n: self._deliver(df, n, bootstrap=False, order=["token"])).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")
        self.query = writer.start()
        self._keep_corrupt(checkpoint, available_now)
        self.on_started()
        try:
            if available_now:
                self.query.awaitTermination()
                if self.dead_letter_query is not None:
                    self.dead_letter_query.awaitTermination()
                self.note_read()
            else:
                while not self.stopping.is_set() and self.query.isActive:
                    self.query.awaitTermination(1)
                    self.tick()
                if self.query.exception():
                    raise self.query.exception()
        finally:
            self.note_read()
            self.query.stop()
            if self.dead_letter_query is not None:
                self.dead_letter_query.stop()
            self.save_interrupted()

    def _keep_corrupt(self, checkpoint: str, available_now: bool) -> None:
        """Write the entries of the log that can't be decoded to the source's dead-letter folder, if it names one."""
        folder = getattr(self.source, "dead_letters", None)
        self.dead_letter_query = None
        if folder:
            writer = self.source.corrupt().writeStream.format("parquet").option("path", folder).option("checkpointLocation", f"{folder.rstrip('/')}-progress")
            writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
            self.dead_letter_query = writer.start()

    def note_read(self) -> None:
        """Take from the query's progress up to where the log has been read in completed batches."""
        for progress in self.query.recentProgress if self.query is not None else []:
            row = progress.observedMetrics.get("read")
            end = row["end"] if row is not None else None
            if end is not None and (self.read_to is None or end["token"] > self.read_to[0]):
                self.read_to = (end["token"], end["t"], end["i"])

    @property
    def settled(self) -> bool:
        """Whether all that was delivered is acknowledged and saved, so that the stream may go on from where Spark's state is."""
        return all(not a.open and not a.pending for a in self.acks.values())

    def follow(self, partitions: list[int], checkpoint: Callable[[], str], available_now: bool = False, tries: int | None = None) -> None:
        """Snapshot where needed and stream, again after failures: lost history starts over, other errors back off."""
        backoff = Backoff(STREAM)
        while not self.stopping.is_set():
            try:
                self.bootstrap(partitions)
                if not self.stopping.is_set():
                    self.stream(partitions, checkpoint(), available_now)
                return
            except HistoryLost as e:
                self._start_over(e.partitions)
                backoff.reset()
            except Exception as e:
                if says_history_lost(str(e)):
                    self._start_over(partitions)
                    backoff.reset()
                    continue
                self.metrics.add("change_stream_error_total")
                self.metrics.add("change_stream_restart_total")
                if tries is not None and backoff.tries + 1 >= tries:
                    raise
                self.log.error("stream failed: %s", e)
                self.sleep(backoff.next())

    def _start_over(self, partitions: Iterable[int]) -> None:
        """Forget the partitions' progress, so that the next try takes a new snapshot of them."""
        self.metrics.add("resume_token_expired_total")
        for p in partitions:
            self.progress.reset(p)
            self.acks.pop(p, None)
        self.sleep(2)

    # --- delivery and acknowledgement ------------------------------------

    def _deliver(self, messages: DataFrame, batch: int, bootstrap: bool, order: list[Any]) -> None:
        if self.stopping.is_set():
            raise InterruptedError("stopping")
        self.drained.clear()
        try:
            if getattr(self.listener, "batch", False):
                self._deliver_batch(messages, batch, bootstrap, order)
            else:
                self._deliver_records(messages, bootstrap, order)
        finally:
            self.drained.set()

    def _looked_up(self, held: DataFrame) -> DataFrame:
        """Messages whose updates came without a document, with the document as it is now (null if it is gone).

        ``held`` is a persisted micro-batch. Only a batch with such updates reads
        the collection, between its least and greatest key.
        """
        bare = held.filter(ops.is_update(F.col("operation_type")) & F.col("full_document").isNull()).select("document_id").distinct()
        rows = self.source.snapshot()
        kind = rows.schema[self.source.key].dataType
        native = F.col("document_id").cast(kind)
        low, high, n = bare.agg(F.min(native), F.max(native), F.count(F.lit(1))).first()
        if not n:
            return held
        key = F.col(self.source.key)
        document = self.document or next(c for c in rows.columns if c != self.source.key)
        near = rows.filter((key >= F.lit(low).cast(kind)) & (key <= F.lit(high).cast(kind))).select(key.cast("string").alias("document_id"), F.col(document).alias("document"))
        wanted = F.broadcast(bare) if n <= LOOKED_UP else bare
        return fill_updates(held, near.join(wanted, "document_id", "left_semi"), n <= LOOKED_UP)

    def _deliver_batch(self, messages: DataFrame, batch: int, bootstrap: bool, order: list[Any]) -> None:
        """The whole frame at once. What a failed call got stays open: nothing of it, or after it, is saved."""
        held = messages.persist()
        try:
            by_operation = {r[0]: r[1] for r in held.groupBy("operation_type").count().collect()}
            if bootstrap:
                last = F.max(F.struct(order[0].alias("k"), "document_id"))["document_id"].alias("last")
                ends = {r["partition_id"]: (r["last"], r["n"], None) for r in held.groupBy("partition_id").agg(last, F.count(F.lit(1)).alias("n")).collect()}
            else:
                flat = held.select("partition_id", "token", "cluster_time.t", "cluster_time.i")
                ends = {r["partition_id"]: (r["token"], r["acked"], {"t": r["t"], "i": r["i"]}) for r in latest_ack(flat).collect()}
            for operation, n in by_operation.items():
                self.metrics.count_operation(operation, n)
            book = self.snapshot_acks if bootstrap else self.acks
            with self.lock:
                for p, (where, _, _) in ends.items():
                    book.setdefault(p, Acks()).deliver(where)
            full = held if bootstrap or not by_operation.get("update") else self._looked_up(held)
            began = time.perf_counter()
            if not self._call(self.listener, full, batch, bootstrap=bootstrap):
                return
            self.metrics.set("listener_latency_seconds", time.perf_counter() - began)
            for p, (where, n, c) in ends.items():
                self.last_event[p] = self.clock()
                book[p].ack(where, c)
                if bootstrap:
                    self.metrics.add("bootstrap_document_total", n)
                else:
                    self.metrics.set("cdc_latency_seconds", max(0.0, self.clock() - c["t"]))
                if self.cfg.checkpoint.type == "auto":
                    (self.commit_bootstrap if bootstrap else self._commit)(p)
        finally:
            held.unpersist()

    def _deliver_records(self, messages: DataFrame, bootstrap: bool, order: list[Any]) -> None:
        """One record at a time in the driver, for listeners that aren't frames' consumers; partitions of bounded size are fetched one by one."""
        held = messages.persist()
        try:
            if not bootstrap and not held.filter(ops.is_update(F.col("operation_type"))).isEmpty():
                full = self._looked_up(held)
            else:
                full = held
            fetches = min(MOST_FETCHES, max(1, -(-held.count() // self.cfg.checkpoint.bootstrap_query_batch_size)))
            for row in full.repartitionByRange(fetches, *order).sortWithinPartitions(*order).toLocalIterator():
                self._deliver_record(row, bootstrap)
        finally:
            held.unpersist()

    def _deliver_record(self, row: Row, bootstrap: bool) -> None:
        if self.stopping.is_set():
            raise InterruptedError("stopping")
        p, where = row["partition_id"], row["document_id"] if bootstrap else row["token"]
        acks = (self.snapshot_acks if bootstrap else self.acks).setdefault(p, Acks())
        acks.deliver(where)
        self.metrics.count_operation(row["operation_type"])
        self.last_event[p] = self.clock()
        if not bootstrap:
            self.metrics.set("cdc_latency_seconds", max(0.0, self.clock() - row["cluster_time"]["t"]))
        began = time.perf_counter()
        self._call(self.listener, Delivery(row, p, bootstrap, lambda: self._ack(p, where, row["cluster_time"], bootstrap)), bootstrap=bootstrap)
        self.metrics.set("listener_latency_seconds", time.perf_counter() - began)

    def _call(self, listener: Listener, *args: Any, bootstrap: bool = False) -> bool:
        """Whether the listener worked. Its errors in a snapshot always stop it, since a skipped row would never come again."""
        try:
            listener(*args)
            return True
        except Exception as e:
            self.metrics.add("listener_error_total")
            if self.on_error == "fail" or bootstrap:
                raise
            self.log.error("listener failed, going on: %s", e)
            return False

    def _ack(self, partition: int, where: Any, cluster_time: Row, bootstrap: bool) -> None:
        with self.lock:
            acks = (self.snapshot_acks if bootstrap else self.acks).get(partition)
            if acks is None:
                return
            acks.ack(where, cluster_time)
            if bootstrap:
                self.metrics.add("bootstrap_document_total")
            k, now = self.cfg.checkpoint, self.clock()
            every = k.bootstrap_save_count if bootstrap else k.change_stream_save_count
            due = bootstrap and now - self.last_bootstrap_save.setdefault(partition, now) >= k.bootstrap_save_interval.total_seconds()
            if k.type == "auto" and (acks.pending >= every or due):
                (self.commit_bootstrap if bootstrap else self._commit)(partition)

    def _commit(self, partition: int) -> None:
        with self.lock:
            acks = self.acks.get(partition)
            if acks is None or acks.ready is None or not acks.pending:
                return
            (token, c), n = acks.ready, acks.pending
            self.progress.save_token(partition, token, (c["t"], c["i"]))
            acks.pending -= n

    def commit(self) -> None:
        """Save what is acknowledged in all partitions."""
        for p in sorted(self.acks):
            self._commit(p)
        self.last_save = self.clock()

    def commit_bootstrap(self, partition: int) -> None:
        with self.lock:
            acks = self.snapshot_acks.get(partition)
            if acks is None:
                if partition not in self.active:
                    self.log.warning("no snapshot of partition %s is running", partition)
                return
            if acks.ready is not None and acks.pending:
                self.progress.save_bootstrap(partition, acks.ready[0])
                acks.pending = 0
                self.last_bootstrap_save[partition] = self.clock()

    # --- time and stop ---------------------------------------------------

    def tick(self) -> None:
        """Periodic save (auto), and a look for idle partitions."""
        now, k = self.clock(), self.cfg.checkpoint
        if k.type == "auto" and now - self.last_save >= k.token_save_interval.total_seconds():
            self.commit()
        if now - self.last_idle_look >= k.idle_heartbeat_interval.total_seconds():
            self.last_idle_look = now
            self.advance_idle(now - k.max_idle_time.total_seconds())

    def advance_idle(self, since: float | None = None) -> None:
        """Save how far the log has been read for partitions without events after ``since`` and without anything in flight.

        What the log holds beyond that has not been read, and is not skipped.
        """
        self.note_read()
        if self.read_to is None or not self.drained.is_set():
            return
        token, t, i = self.read_to
        for p in sorted(self.active):
            idle = since is None or self.last_event.get(p, self.began) < since
            if idle and not (self.acks.get(p) and (self.acks[p].open or self.acks[p].pending)) and (self.progress.read(p).get("resume_token") or -1) < token:
                self.progress.advance(p, token, (t, i))

    def save_interrupted(self) -> None:
        """Save what is acknowledged, where saving isn't the user's."""
        if self.cfg.checkpoint.type == "auto":
            self.commit()
            for p in list(self.snapshot_acks):
                self.commit_bootstrap(p)

    def stop(self) -> None:
        """Refuse new work, wait for what is in flight, save."""
        self.stopping.set()
        self.drained.wait(self.cfg.graceful_shutdown_timeout.total_seconds())
        if self.query is not None:
            self.query.stop()
        self.save_interrupted()
