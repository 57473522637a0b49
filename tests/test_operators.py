import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.functions.hashing import partition_of
from tributary.functions.sequence import merge_latest, running_number
from tributary.operators import changes, checkpoints, coordination, feed, snapshot
from tributary.streaming.group import contiguous

LOG = "token long, doc_id string, operation_type string, document string, t long, i long"


def test_partition_is_total_stable_and_in_range(spark):
    rows = spark.createDataFrame([(x,) for x in ["a", "", None, "é", "1", "1" * 5000]], "k string").select("k", partition_of(F.col("k"), 7).alias("p")).collect()
    assert all(0 <= r.p < 7 for r in rows)
    by_number = spark.range(50).select(partition_of(F.col("id"), 7).alias("p")).collect()
    by_text = spark.range(50).select(partition_of(F.col("id").cast("string"), 7).alias("p")).collect()
    assert by_number == by_text


def test_messages(spark):
    log = spark.createDataFrame([(1, "a", "insert", "{}", 5, 1), (2, "a", "delete", "{}", 6, 1), (3, "b", "drop", None, 6, 2), (4, "b", None, None, 7, 1), (5, "c", "update", None, 8, 1)], LOG)
    rows = {r.token: r for r in changes.to_messages(log, "d", "c", 3).collect()}
    assert set(rows) == {1, 2, 5}
    assert rows[1].event_time == dt.datetime(1970, 1, 1, 0, 0, 5) and rows[1].full_document == "{}" and rows[2].full_document is None and rows[5].full_document is None
    assert {(r.token, r.reason) for r in changes.reject_unsupported(log).collect()} == {(3, "unsupported operation type: drop"), (4, "unsupported operation type: null")}


def test_decode_routes_corrupt_rows(spark):
    good = '{"operation_type":"insert","document_key":{"_id":"a"},"full_document":"{}","ns":{"db":"d","coll":"c"},"cluster_time":{"t":1,"i":2},"token":9}'
    log, bad = changes.decode(spark.createDataFrame([(good,), ("{",), (None,), ("{}",)], "value string"))
    assert [tuple(r) for r in log.collect()] == [(9, "a", "insert", "{}", 1, 2)]
    assert sorted(str(r.value) for r in bad.collect()) == ["None", "{", "{}"]


def test_clamp(spark):
    r = spark.range(1).select(changes.clamp_seconds(F.lit(-5)).alias("a"), changes.clamp_seconds(F.lit(2**40)).alias("b")).first()
    assert (r.a, r.b) == (0, 4_294_967_295)


def test_snapshot_partitions_are_disjoint_and_total(spark):
    docs = spark.range(100).withColumnRenamed("id", "k")
    parts = [{r.k for r in snapshot.scan(docs, "k", 5, only=[p]).collect()} for p in range(5)]
    assert sum(map(len, parts)) == 100 and set.union(*parts) == set(range(100))
    assert {r.k for r in snapshot.scan(docs, "k", 5, after=60).collect()} == set(range(61, 100))


def test_update_lookup_sees_the_present(spark):
    log = spark.createDataFrame([(1, "a", "insert", "1", 1, 1), (2, "a", "update", "2", 2, 1), (3, "a", "replace", "3", 3, 1), (4, "b", "update", "x", 4, 1), (5, "b", "delete", None, 5, 1)], LOG)
    rows = {r.token: r.document for r in feed.look_up_updates(log, feed.current_state(log)).collect()}
    assert rows == {2: "3", 4: None}


def test_start_state(spark):
    rows = spark.createDataFrame([(0, None, None, None), (1, 5, None, None), (2, None, 9, None), (3, 5, 9, None), (4, 5, 9, "k")], "partition_id int, resume_token long, t long, bootstrap_last_id string")
    got = {r.partition_id: r.start for r in feed.start_state(rows).collect()}
    assert got == {0: "bootstrap", 1: "resume_token", 2: "start_at_time", 3: "resume_token", 4: "bootstrap"}


def test_contiguous_commit_stops_at_the_first_open(spark):
    rows = spark.createDataFrame([(0, 1, True), (0, 2, False), (0, 3, True), (1, 1, True), (1, 4, True), (2, 1, False)], "partition_id int, token long, acked boolean")
    assert {r.partition_id: r.token for r in checkpoints.contiguous_commit(rows).collect()} == {0: 1, 1: 4}


def test_fold_writes(spark):
    schema = "seq long, kind string, partition_id int, resume_token long, t long, i long, bootstrap_last_id string"
    rows = [
        (1, "save_progress", 0, None, None, None, "k1"), (2, "save_token", 0, 5, 50, 1, None), (3, "save_token", 0, None, None, None, None),
        (1, "save_token", 1, 7, 70, 1, None), (2, "save_token", 1, 8, None, None, None), (3, "advance", 1, 99, 90, 1, None),
        (1, "save_token", 2, 7, 70, 1, None), (2, "clear_token", 2, 3, 3, 3, None), (3, "save_progress", 2, None, None, None, "k"), (4, "clear_progress", 2, None, None, None, "z"),
    ]
    got = {r.partition_id: tuple(r)[1:6] for r in checkpoints.fold_writes(spark.createDataFrame(rows, schema)).collect()}
    assert got == {0: (5, 50, 1, "k1", False), 1: (None, 90, 1, None, False), 2: (None, None, None, None, False)}


def test_running_number_crosses_ranges(spark):
    rows = spark.range(0, 50).select((F.col("id") % 3).alias("k"), (F.col("id") * 7).alias("o"))
    got = running_number(rows, "k", "o", "n", width=40).collect()
    for k in range(3):
        assert [r.n for r in sorted((r for r in got if r.k == k), key=lambda r: r.o)] == list(range(1, len([r for r in got if r.k == k]) + 1))
    assert running_number(rows.filter("k > 5"), "k", "o", "n").count() == 0


def test_merge_latest(spark):
    a = spark.createDataFrame([(1, 1, "x"), (2, 1, "y")], "k int, v int, s string")
    b = spark.createDataFrame([(2, 2, "z"), (3, 1, "w")], "k int, v int, s string")
    assert {r.k: r.s for r in merge_latest(a, b, "k", "v").collect()} == {1: "x", 2: "z", 3: "w"}


@given(st.integers(1, 30), st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_contiguous_ranges_cover(workers, partitions):
    names = [f"w-{i:03}" for i in range(workers)]
    parts = [contiguous(names, w, partitions) for w in names]
    assert [p for x in parts for p in x] == list(range(partitions))
    assert max(map(len, parts)) - min(map(len, parts)) <= 1


@pytest.mark.parametrize("n", [1, 2, 4, 9])
def test_expected_frame_equals_rule(spark, n):
    names = sorted(f"w-{i}" for i in range(n * 3))  # w-10 comes before w-9
    frame = coordination.expected(spark.createDataFrame([(w,) for w in names], "worker_id string"), 15)
    got = {}
    for r in frame.collect():
        got.setdefault(r.worker_id, []).append(r.partition_id)
    assert all(sorted(got.get(w, [])) == contiguous(names, w, 15) for w in names)


def test_cutoff_is_inclusive(spark):
    rows = spark.createDataFrame([("a", 9), ("b", 10), ("c", 11)], "worker_id string, last_heartbeat long")
    assert {r.worker_id for r in coordination.alive(rows, F.lit(10)).collect()} == {"b", "c"}
    assert {r.worker_id for r in coordination.dead(rows, F.lit(10)).collect()} == {"a"}


def test_lost_history_is_recognised(spark):
    said = ["cannot resume stream; try again", "the resume token is invalid", "an invalid resume token", "the resume token", None, "(ChangeStreamHistoryLost) gone", "timeout"]
    assert [feed.says_history_lost(x) for x in said] == [True, True, True, False, False, True, False]
    rows = feed.history_lost_errors(spark.createDataFrame([(x,) for x in said], "message string")).collect()
    assert {r.message for r in rows} == {x for x in said if feed.says_history_lost(x)}
