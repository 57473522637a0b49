import json
import threading
import time
import urllib.request

import pytest
from pyspark.sql import functions as F

from tributary.sources.change_source import LOG, ParquetChangeSource
from tributary.sources.config import Config, ConfigError, duration, from_tree, load
from tributary.sources.control import FileControlStore, MemoryControlStore
from tributary.streaming.backoff import Backoff, Policy, retry
from tributary.streaming.connector import Connector
from tributary.streaming.group import Group, TotalPartitionMismatch
from tributary.streaming.logs import get_logger
from tributary.streaming.metrics import Metrics, MetricServer
from tributary.streaming.progress import Acks, Progress
from tributary.streaming.runtime import PartitionEventHandler


def config(**partition):
    cfg = Config()
    c = cfg.connection
    c.uri, c.database, c.collection = "file", "shop", "items"
    cfg.partition.consumer_group, cfg.partition.total_partition = "g", partition.get("total", 4)
    cfg.checkpoint.bootstrap_slice_rows, cfg.checkpoint.bootstrap_save_count, cfg.checkpoint.change_stream_save_count = 7, 3, 2
    return cfg


def events(spark, folder, rows):
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def source(spark, tmp_path):
    spark.range(20).select(F.col("id").alias("_id"), F.format_string('{"n": %d}', "id").alias("doc")).write.parquet(f"{tmp_path}/coll")
    events(spark, f"{tmp_path}/log", [(0, "0", "insert", "{}", 100, 1), (1, "1", "insert", "{}", 100, 2)])
    return ParquetChangeSource(spark, f"{tmp_path}/coll", f"{tmp_path}/log")


class Collect:
    def __init__(self, batch=False, skip=()):
        self.batch, self.rows, self.skip = batch, [], set(skip)

    def __call__(self, what, *_):
        if self.batch:
            self.rows += [(r.document_id, r.operation_type, r.is_bootstrap, r.token) for r in what.collect()]
            return
        m = what.message
        self.rows.append((m.document_id, m.operation_type, what.is_bootstrap, m.token))
        if m.token not in self.skip:
            what.ack()


@pytest.mark.parametrize("batch", [False, True])
def test_snapshot_then_changes_then_resume(spark, tmp_path, source, batch):
    store, listener = MemoryControlStore(), Collect(batch)
    Connector(spark, config(), listener, source, f"{tmp_path}/state", store, document="doc", me="w").start(available_now=True)
    assert sorted(int(r[0]) for r in listener.rows) == list(range(20)) and all(r[2] for r in listener.rows)
    events(spark, source.log, [(2, "3", "update", "{}", 101, 1), (3, "4", "delete", None, 101, 2), (4, "5", "drop", None, 102, 1)])
    again = Collect(batch)
    c = Connector(spark, config(), again, source, f"{tmp_path}/state", store, document="doc", me="w")
    c.start(available_now=True)
    assert sorted(again.rows, key=lambda r: r[3]) == [("3", "update", False, 2), ("4", "delete", False, 3)]
    assert c.metrics.counters["update_total"] == 1 and c.metrics.counters["delete_total"] == 1
    third = Collect(batch)
    Connector(spark, config(), third, source, f"{tmp_path}/state", store, document="doc", me="w").start(available_now=True)
    assert third.rows == []


def test_unacked_events_are_delivered_again(spark, tmp_path, source):
    store = MemoryControlStore()
    cfg = config(total=1)
    Connector(spark, cfg, Collect(), source, f"{tmp_path}/state", store, document="doc", me="w").start(available_now=True)
    events(spark, source.log, [(n, str(n), "update", "{}", 101, n) for n in range(2, 8)])
    Connector(spark, cfg, Collect(skip={4}), source, f"{tmp_path}/state", store, document="doc", me="w").start(available_now=True)
    again = Collect()
    Connector(spark, cfg, again, source, f"{tmp_path}/state", store, document="doc", me="w").start(available_now=True)
    assert [r[3] for r in again.rows] == [4, 5, 6, 7]


def test_interrupted_snapshot_resumes_and_keeps_its_first_watermark(spark, tmp_path, source):
    store = MemoryControlStore()

    class Fails(Collect):
        def __call__(self, what, *_):
            if len(self.rows) == 12:
                raise RuntimeError("stop here")
            super().__call__(what)

    first = Connector(spark, config(total=1), Fails(), source, f"{tmp_path}/state", store, document="doc", me="w")
    first.runtime.sleep = lambda s: None
    first.group.register()
    first.group.record(first.group.acquire())
    with pytest.raises(RuntimeError):
        first.runtime.bootstrap([0])
    first.runtime.save_interrupted()
    assert first.progress.read(0)["bootstrap_start"] == [1, 100, 2]
    events(spark, source.log, [(2, "3", "update", "{}", 101, 1)])
    second = Collect()
    Connector(spark, config(total=1), second, source, f"{tmp_path}/state", store, document="doc", me="w").start(available_now=True)
    assert [int(r[0]) for r in second.rows if r[2]] == list(range(12, 20))
    assert [r[3] for r in second.rows if not r[2]] == [2]


def test_lost_history_takes_a_new_snapshot(spark, tmp_path, source):
    store, cfg = MemoryControlStore(), config(total=1)
    Connector(spark, cfg, Collect(), source, f"{tmp_path}/state", store, document="doc", me="w").start(available_now=True)
    trimmed = f"{tmp_path}/log2"
    events(spark, trimmed, [(50, "3", "update", "{}", 200, 1)])
    listener = Collect()
    c = Connector(spark, cfg, listener, ParquetChangeSource(spark, source.collection, trimmed), f"{tmp_path}/state", store, document="doc", me="w")
    c.runtime.sleep = lambda s: None
    c.start(available_now=True)
    assert sum(r[2] for r in listener.rows) == 20 and c.metrics.counters["resume_token_expired_total"] == 1


def test_listener_errors_skip_or_fail(spark, tmp_path, source):
    store, cfg = MemoryControlStore(), config(total=1)
    Connector(spark, cfg, Collect(), source, f"{tmp_path}/state", store, document="doc", me="w").start(available_now=True)
    events(spark, source.log, [(2, "3", "update", "{}", 101, 1), (3, "4", "update", "{}", 101, 2)])

    def bad(what):
        if what.message.token == 2:
            raise RuntimeError("no")
        what.ack()

    c = Connector(spark, cfg, bad, source, f"{tmp_path}/state", store, on_error="skip", document="doc", me="w")
    c.start(available_now=True)
    assert c.metrics.counters["listener_error_total"] == 1
    c = Connector(spark, cfg, bad, source, f"{tmp_path}/state", store, document="doc", me="w")
    c.runtime.sleep = lambda s: None
    with pytest.raises(Exception, match="no"):
        c.start(available_now=True)


def test_acks_commit_the_prefix():
    a = Acks()
    for n in (1, 2, 3):
        a.deliver(n)
    a.ack(2, "b")
    assert a.ready is None
    a.ack(1, "a")
    assert a.ready == (2, "b") and a.pending == 2
    a.ack(2, "b")
    assert a.pending == 2


def test_idle_partitions_advance_only_without_open_events(spark, tmp_path, source):
    c = Connector(spark, config(total=2), Collect(), source, f"{tmp_path}/state", MemoryControlStore(), document="doc", me="w")
    c.runtime.active = {0, 1}
    c.runtime.acks[1] = Acks()
    c.runtime.acks[1].deliver(0)
    c.runtime.advance_idle()
    assert c.progress.read(0) == {}  # nothing has been read yet, so nothing may be skipped
    c.runtime.read_to = (1, 100, 2)
    c.runtime.advance_idle()
    assert c.progress.read(0)["resume_token"] == 1 and c.progress.read(1) == {}


def test_progress_is_partial():
    p = Progress(MemoryControlStore(), config(), Metrics(), lambda: 1.0)
    p.save_token(0, 5, (1, 1))
    p.save_token(0, 6, None)
    p.save_token(0, None, None)
    assert p.start(0) == ("resume_token", 6) and p.read(0)["last_cluster_time"] == [1, 1]
    p.advance(0, None, (9, 1))
    assert p.start(0) == ("start_at_time", [9, 1])
    p.write(0, last_cluster_time=[0, 0])
    assert p.start(0)[0] == "bootstrap"
    p.reset(7)
    assert p.read(7) == {}


def test_group_takeover_and_rebalance():
    store, now = MemoryControlStore(), [1000.0]
    make = lambda name: Group(store, config().partition, name, clock=lambda: now[0])
    a, b = make("a"), make("b")
    a.register()
    a.record(a.acquire())
    assert a.owned == [0, 1, 2, 3]
    b.register()
    assert a.needs_rebalance()
    seen = []
    a.resync(lambda got: seen.append(got))
    assert a.owned == [0, 1] and seen == [[0, 1]]
    b.record(b.acquire())
    assert b.owned == [2, 3] and not b.needs_rebalance() and b.is_mine(2) and not a.is_mine(2)
    now[0] += 1000
    b.heartbeat()
    assert b.resync(lambda got: None) == [0, 1, 2, 3]
    other = config(total=9).partition
    a.guard_total()
    with pytest.raises(TotalPartitionMismatch):
        Group(store, other, "c").guard_total()
    b.stop()
    assert store.read(b.workers) == {} and store.read(b.assignments) == {}


def test_file_store_is_exclusive(tmp_path):
    store = FileControlStore(tmp_path)

    def add():
        for _ in range(25):
            store.update("t", lambda rows: rows.__setitem__("n", {"v": rows.get("n", {"v": 0})["v"] + 1}))

    threads = [threading.Thread(target=add) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert store.read("t") == {"n": {"v": 100}} and store.read("other") == {}


def test_config(tmp_path):
    tree = {"connection": {"uri": "u", "database": "d", "collection": "c", "maxPoolSize": 7}, "checkpoint": {"tokenSaveTimeout": "5s", "maxIdleTime": 1_000_000_000, "idleHeartbeatInterval": "1m30s"}, "partition": {"consumerGroup": "g"}}
    (tmp_path / "a.json").write_text(json.dumps(tree))
    import yaml

    (tmp_path / "b.yaml").write_text(yaml.safe_dump({"cdc": tree}))
    for f in ("a.json", "b.yaml"):
        cfg = load(tmp_path / f).validate()
        assert cfg.connection.max_pool_size == 7 and cfg.checkpoint.save_timeout.total_seconds() == 5 and cfg.checkpoint.max_idle_time.total_seconds() == 1 and cfg.checkpoint.idle_heartbeat_interval.total_seconds() == 90
        assert cfg.partition.total_partition == 15
    (tmp_path / "c.toml").write_text("")
    with pytest.raises(ConfigError):
        load(tmp_path / "c.toml")
    for path, value in (("connection.uri", " "), ("partition.consumer_group", ""), ("connection.username", "u"), ("connection.min_pool_size", 999), ("checkpoint.type", "x"), ("checkpoint.bootstrap_save_count", 0)):
        cfg = from_tree(tree)
        part, name = path.split(".")
        setattr(getattr(cfg, part), name, value)
        with pytest.raises(ConfigError):
            cfg.validate()
    cfg.connection.password = "secret"
    assert cfg.masked().connection.password == "***" and cfg.connection.password == "secret"
    assert duration("1h").total_seconds() == 3600
    with pytest.raises(ConfigError):
        duration("soon")


def test_backoff():
    b = Backoff(Policy(1, 5), jitter=lambda: 0)
    assert [b.next() for _ in range(5)] == [1, 2, 4, 5, 5] and b.exhausted
    calls = []
    with pytest.raises(ZeroDivisionError):
        retry(lambda: calls.append(1) or 1 / 0, Policy(1, 5), sleep=lambda s: None)
    assert len(calls) == 4


def test_metrics_exposition_and_server():
    m = Metrics(clock=lambda: 100.0)
    names = {n for n, _, _ in m.collect()}
    assert "tributary_event_lag_seconds" not in names
    assert ("tributary_time_since_last_checkpoint_seconds", "gauge", -1.0) in m.collect()
    m.count_operation("insert")
    assert "tributary_event_lag_seconds" in {n for n, _, _ in m.collect()} and len({n for n, _, _ in m.collect()}) == 22
    a, b = MetricServer(m, 18480), MetricServer(m, 18480)
    try:
        assert a.port != b.port
        body = urllib.request.urlopen(f"http://127.0.0.1:{b.port}/metrics").read().decode()
        assert "tributary_insert_total 1" in body and "build_info" in body
        assert urllib.request.urlopen(f"http://127.0.0.1:{a.port}/health").read() == b"OK"
    finally:
        a.close(), b.close()


def test_logger_levels():
    assert get_logger("trace").level == get_logger("debug").level
    with pytest.raises(ValueError):
        get_logger("loud")


class Hooks(PartitionEventHandler):
    def __init__(self):
        self.calls = []

    def before_partition_start(self, partition):
        self.calls.append(("before start", partition))

    def after_partition_start(self, partition):
        self.calls.append(("after start", partition))

    def before_partition_stop(self, partition):
        self.calls.append(("before stop", partition))

    def after_partition_stop(self, partition):
        self.calls.append(("after stop", partition))


def wait(condition, seconds=60):
    end = time.time() + seconds
    while not condition() and time.time() < end:
        time.sleep(0.2)
    return condition()


def test_live_connector_follows_rebalances_and_closes(spark, tmp_path, source):
    cfg, store, listener, hooks = config(total=4), MemoryControlStore(), Collect(), Hooks()
    cfg.partition.rebalance_check_interval = cfg.partition.heartbeat_interval = cfg.checkpoint.token_save_interval = duration("1s")
    cfg.metric.port = 18490
    c = Connector(spark, cfg, listener, source, f"{tmp_path}/state", store, document="doc", me="a")
    c.set_event_handler(hooks)
    runner = threading.Thread(target=c.start, daemon=True)
    runner.start()
    try:
        assert wait(lambda: ("after start", 3) in hooks.calls)
        assert hooks.calls[:8] == [("before start", p) for p in range(4)] + [("after start", p) for p in range(4)]
        events(spark, source.log, [(2, "3", "update", "{}", 101, 1)])
        assert wait(lambda: any(r[3] == 2 for r in listener.rows))
        other = Group(store, cfg.partition, "b")
        other.register()
        assert wait(lambda: ("after stop", 3) in hooks.calls and c.group.owned == [0, 1])
        other.record(other.acquire())
        assert other.owned == [2, 3]
    finally:
        c.close()
        runner.join(30)
    assert not runner.is_alive() and "a" not in store.read(c.group.workers)


def test_watermark_falls_back_to_the_clock(spark, tmp_path, source):
    class Mute(ParquetChangeSource):
        def high_watermark(self):
            raise OSError("away")

    c = Connector(spark, config(total=1), Collect(), Mute(spark, source.collection, source.log), f"{tmp_path}/state", MemoryControlStore(), document="doc", me="w")
    c.runtime.sleep, c.runtime.clock = lambda s: None, lambda: 500.7
    assert c.runtime.low_watermark() == (None, 500, 1)
    c.progress.begin_bootstrap(0, c.runtime.low_watermark())
    c.progress.finish_bootstrap(0)
    assert c.progress.start(0) == ("start_at_time", [500, 1])


def connect(spark, tmp_path, source, store, listener, cfg=None, **kwargs):
    c = Connector(spark, cfg or config(), listener, source, f"{tmp_path}/state", store, document="doc", me="w", **kwargs)
    c.runtime.sleep = c.group.sleep = lambda s: None
    return c


class Flaky(Collect):
    """A batch listener whose call number ``fails`` fails."""

    def __init__(self, fails):
        super().__init__(True)
        self.fails, self.calls = fails, 0

    def __call__(self, what, *_):
        self.calls += 1
        if self.calls == self.fails:
            raise RuntimeError("no")
        super().__call__(what)


def test_failed_snapshot_slices_are_not_skipped(spark, tmp_path, source):
    listener = Flaky(2)
    connect(spark, tmp_path, source, MemoryControlStore(), listener, on_error="skip").start(available_now=True)
    assert {int(r[0]) for r in listener.rows} == set(range(20)) and listener.calls > 3


def test_failed_batches_stay_open_when_errors_are_skipped(spark, tmp_path, source):
    store = MemoryControlStore()
    connect(spark, tmp_path, source, store, Collect(True)).start(available_now=True)
    events(spark, source.log, [(2, "3", "replace", "{}", 101, 1)])
    connect(spark, tmp_path, source, store, Flaky(1), on_error="skip").start(available_now=True)
    again = Collect(True)
    connect(spark, tmp_path, source, store, again).start(available_now=True)
    assert [r[3] for r in again.rows] == [2]


def test_idle_looks_skip_nothing_unread(spark, tmp_path, source):
    store = MemoryControlStore()
    connect(spark, tmp_path, source, store, Collect(True)).start(available_now=True)
    events(spark, source.log, [(9, "3", "replace", "{}", 101, 1)])
    c = connect(spark, tmp_path, source, store, Collect(True))
    c.runtime.active = set(range(4))
    c.runtime.advance_idle()
    again = Collect(True)
    connect(spark, tmp_path, source, store, again).start(available_now=True)
    assert [r[3] for r in again.rows] == [9]


def test_idle_partitions_move_to_what_was_read(spark, tmp_path, source):
    store, cfg = MemoryControlStore(), config(total=2)
    connect(spark, tmp_path, source, store, Collect(True), cfg).start(available_now=True)
    events(spark, source.log, [(n, "3", "drop" if n > 5 else "replace", "{}", 101, n) for n in range(2, 9)])
    c = connect(spark, tmp_path, source, store, Collect(True), cfg)
    c.start(available_now=True)
    c.runtime.advance_idle()
    assert c.runtime.read_to == (8, 101, 8) and {c.progress.read(p)["resume_token"] for p in (0, 1)} == {8}


def test_old_time_starts_lose_history(spark, tmp_path, source):
    store, cfg, listener = MemoryControlStore(), config(total=1), Collect(True)
    c = connect(spark, tmp_path, source, store, listener, cfg)
    c.progress.write(0, last_cluster_time=[10, 1])
    c.start(available_now=True)
    assert c.metrics.counters["resume_token_expired_total"] == 1 and sum(r[2] for r in listener.rows) == 20
    kept = Collect(True)
    c = connect(spark, tmp_path, source, MemoryControlStore(), kept, cfg)
    c.progress.write(0, last_cluster_time=[100, 2])
    c.start(available_now=True)
    assert c.metrics.counters["resume_token_expired_total"] == 0 and [r[3] for r in kept.rows] == [1]


@pytest.mark.parametrize("batch", [False, True])
def test_manual_mode_saves_on_commit_only(spark, tmp_path, source, batch):
    store, cfg = MemoryControlStore(), config()
    connect(spark, tmp_path, source, store, Collect(batch), cfg).start(available_now=True)
    events(spark, source.log, [(2, "3", "replace", "{}", 101, 1)])
    cfg.checkpoint.type = "manual"
    tokens = lambda c: {p: c.progress.read(p)["resume_token"] for p in range(4)}
    for commit in (False, True):
        listener = Collect(batch)
        c = connect(spark, tmp_path, source, store, listener, cfg)
        before = tokens(c)
        c.start(available_now=True)
        assert [r[3] for r in listener.rows] == [2] and tokens(c) == before
        if commit:
            c.commit()
    assert 2 in tokens(c).values()
    last = Collect(batch)
    connect(spark, tmp_path, source, store, last, cfg).start(available_now=True)
    assert last.rows == []


@pytest.mark.parametrize("batch", [False, True])
def test_updates_without_a_document_get_the_current_one(spark, tmp_path, source, batch):
    store, seen = MemoryControlStore(), {}

    def listener(what, *_):
        for r in what.collect() if batch else [what.message]:
            seen[r.token] = r.full_document
        batch or what.ack()

    listener.batch = batch
    connect(spark, tmp_path, source, store, Collect(batch)).start(available_now=True)
    events(spark, source.log, [(2, "3", "update", None, 101, 1), (3, "99", "update", None, 101, 2), (4, "5", "update", "kept", 101, 3), (5, "6", "delete", None, 101, 4)])
    c = connect(spark, tmp_path, source, store, listener)
    c.start(available_now=True)
    assert seen == {2: '{"n": 3}', 3: None, 4: "kept", 5: None}
    assert c.metrics.gauges["listener_latency_seconds"] > 0 and c.metrics.gauges["cdc_latency_seconds"] > 0


def test_json_log_and_its_dead_letters(spark, tmp_path, source):
    from tributary.sources.change_source import JsonChangeSource

    line = lambda n, op: json.dumps({"operation_type": op, "document_key": {"_id": str(n)}, "full_document": "{}", "ns": {"db": "d", "coll": "c"}, "cluster_time": {"t": 100 + n, "i": 1}, "token": n})
    log, store = tmp_path / "json", MemoryControlStore()
    log.mkdir()
    (log / "a.txt").write_text(line(0, "insert") + "\n")
    source = JsonChangeSource(spark, source.collection, str(log), dead_letters=f"{tmp_path}/dead")
    assert source.high_watermark() == (0, 100, 1) == source.oldest_available()
    connect(spark, tmp_path, source, store, Collect(True)).start(available_now=True)
    (log / "b.txt").write_text("\n".join([line(1, "replace"), "{not json", line(2, "delete")]) + "\n")
    listener = Collect(True)
    connect(spark, tmp_path, source, store, listener).start(available_now=True)
    assert sorted(r[3] for r in listener.rows) == [1, 2]
    assert [r.value for r in spark.read.parquet(f"{tmp_path}/dead").collect()] == ["{not json"]


def test_restart_reads_new_files_only(spark, tmp_path, source):
    store = MemoryControlStore()
    connect(spark, tmp_path, source, store, Collect(True)).start(available_now=True)
    first = connect(spark, tmp_path, source, store, Collect(True))
    first.start(available_now=True)
    assert sum(p.numInputRows for p in first.runtime.query.recentProgress) == 0
    events(spark, source.log, [(n, str(n), "replace", "{}", 101, n) for n in range(2, 7)])
    listener = Collect(True)
    c = connect(spark, tmp_path, source, store, listener)
    c.start(available_now=True)
    assert sum(p.numInputRows for p in c.runtime.query.recentProgress) == 5 and len(listener.rows) == 5
    # a partition that went back is read again from a state of its own
    c.progress.write(0, resume_token=-1)
    again = Collect(True)
    c = connect(spark, tmp_path, source, store, again)
    c.start(available_now=True)
    assert sum(p.numInputRows for p in c.runtime.query.recentProgress) == 7


def test_log_ends_come_from_footers(spark, tmp_path, source):
    from tributary.sources.change_source import footer_end

    events(spark, source.log, [(7, "1", "insert", "{}", 105, 3)])
    assert source.high_watermark() == (7, 105, 3) and source.oldest_available() == (0, 100, 1)
    assert footer_end(spark, source.log, F.max) == 7
    spark.createDataFrame([], LOG).write.parquet(f"{tmp_path}/none")
    none = ParquetChangeSource(spark, source.collection, f"{tmp_path}/none")
    assert none.high_watermark() == (-1, 0, 0) and none.oldest_available() is None


def test_stale_locks_are_broken_once(tmp_path):
    from tributary.sources.control import LockLost

    store = FileControlStore(tmp_path, stale_s=0.3, wait_s=5)
    (tmp_path / "t.lock").write_text("someone gone")
    add = lambda: store.update("t", lambda rows: rows.__setitem__("n", {"v": rows.get("n", {"v": 0})["v"] + 1}))
    threads = [threading.Thread(target=add) for _ in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert store.read("t") == {"n": {"v": 8}}

    def slow(rows):
        (tmp_path / "t.lock").write_text("another took it")
        rows["n"] = {"v": 0}

    with pytest.raises(LockLost):
        store.update("t", slow)
    assert store.read("t") == {"n": {"v": 8}}
    held = FileControlStore(tmp_path, stale_s=60, wait_s=0.2)
    (tmp_path / "u.lock").write_text("alive")
    with pytest.raises(TimeoutError):
        held.update("u", lambda rows: None)
    assert abs(store.now() - time.time()) < 5


def test_worker_off_the_list_registers_again():
    store, now = MemoryControlStore(), [1000.0]
    g = Group(store, config().partition, "a", clock=lambda: now[0], sleep=lambda s: None)
    g.register()
    store.update(g.workers, lambda rows: rows.clear())
    assert g.acquire() == [0, 1, 2, 3]

    class Dead(MemoryControlStore):
        def read(self, table):
            return {}

    lost = Group(Dead(), config().partition, "a", sleep=lambda s: None)
    with pytest.raises(RuntimeError, match="not among"):
        lost.acquire()


def test_checkpoint_saves_give_up_in_time():
    class Broken(MemoryControlStore):
        def update(self, table, change):
            raise OSError("away")

    cfg = config()
    cfg.checkpoint.save_timeout = duration("50ms")
    p, began = Progress(Broken(), cfg, Metrics()), time.monotonic()
    with pytest.raises(OSError):
        p.save_token(0, 1, (1, 1))
    assert time.monotonic() - began < 0.5 and p.metrics.counters["checkpoint_save_error_total"] == 1
