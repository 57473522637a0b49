"""The named queries over the test tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators import changes, checkpoints, coordination, feed, metrics, snapshot
from tributary.plans import fixtures as fx
from tributary.plans.fixtures import ALIVE, ASSIGNMENTS, CHECKPOINTS, COLLECTION, DATABASE, EXPECTED, LOG, PARTITIONS, ROUTED, TIMEOUT_S, WORKERS, hash_sql, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
EPOCH = 1_700_000_000


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _cutoff(spark: SparkSession, d: str):
    """The oldest heartbeat of a living worker, read from the log's clock."""
    return F.lit(fx.now(spark, d).first()["now"] - TIMEOUT_S)


def _messages(spark: SparkSession, d: str) -> DataFrame:
    return changes.to_messages(fx.log(spark, d), DATABASE, COLLECTION, PARTITIONS)


def _flat(messages: DataFrame) -> DataFrame:
    return messages.withColumn("t", F.col("cluster_time.t")).withColumn("i", F.col("cluster_time.i")).drop("cluster_time").withColumn("event_time", F.col("event_time").cast("long"))


_MESSAGE_COLUMNS = f"t AS event_time, doc_id AS document_id, CASE WHEN operation_type <> 'delete' THEN document END AS full_document, operation_type, '{DATABASE}' AS database, '{COLLECTION}' AS collection, t, i, FALSE AS is_bootstrap, partition_id, token"


@query(f"WITH {LOG} SELECT token, doc_id, operation_type FROM log WHERE operation_type IN ('insert', 'update', 'delete', 'replace')")
def ops_filter(spark: SparkSession, d: str) -> DataFrame:
    return changes.filter_operations(fx.log(spark, d)).select("token", "doc_id", "operation_type")


@query(f"WITH {LOG} SELECT token, doc_id, 'unsupported operation type: ' || operation_type AS reason FROM log WHERE operation_type NOT IN ('insert', 'update', 'delete', 'replace')")
def unsupported_ops(spark: SparkSession, d: str) -> DataFrame:
    return changes.reject_unsupported(fx.log(spark, d)).select("token", "doc_id", "reason")


@query(f"WITH {ROUTED} SELECT {_MESSAGE_COLUMNS} FROM routed")
def message_projection(spark: SparkSession, d: str) -> DataFrame:
    return _flat(_messages(spark, d))


@query(f"WITH {ROUTED} SELECT token, operation_type = 'insert' AS is_insert, operation_type = 'update' AS is_update, operation_type = 'delete' AS is_delete, operation_type = 'replace' AS is_replace FROM routed")
def op_predicates(spark: SparkSession, d: str) -> DataFrame:
    op = F.col("operation_type")
    return fx.routed(spark, d).select("token", changes.is_insert(op).alias("is_insert"), changes.is_update(op).alias("is_update"), changes.is_delete(op).alias("is_delete"), changes.is_replace(op).alias("is_replace"))


@query(f"WITH {ROUTED} SELECT token, partition_id FROM routed")
def partition_route(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).select("token", "partition_id")


@query(f"WITH {ROUTED} SELECT partition_id, count(*) AS n FROM routed GROUP BY partition_id")
def partition_counts(spark: SparkSession, d: str) -> DataFrame:
    return _messages(spark, d).groupBy("partition_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT o_orderkey, o_custkey, {hash_sql('o_orderkey')} AS partition_id FROM orders WHERE {hash_sql('o_orderkey')} = 3")
def snapshot_partition_scan(spark: SparkSession, d: str) -> DataFrame:
    return snapshot.scan(table(spark, d, "orders"), "o_orderkey", PARTITIONS, only=[3]).select("o_orderkey", "o_custkey", "partition_id").orderBy("o_orderkey")


@query(f"SELECT o_orderkey, o_custkey, {hash_sql('o_orderkey')} AS partition_id FROM orders WHERE o_orderkey > 700 AND {hash_sql('o_orderkey')} = 3")
def snapshot_resume(spark: SparkSession, d: str) -> DataFrame:
    return snapshot.scan(table(spark, d, "orders"), "o_orderkey", PARTITIONS, after=700, only=[3]).select("o_orderkey", "o_custkey", "partition_id").orderBy("o_orderkey")


@query(f"SELECT o_orderkey, {hash_sql('o_orderkey')} AS partition_id FROM orders WHERE o_orderkey > {hash_sql('o_orderkey')} * 50")
def snapshot_resume_by_partition(spark: SparkSession, d: str) -> DataFrame:
    progress = spark.range(PARTITIONS).select(F.col("id").cast("int").alias("partition_id"), (F.col("id") * 50).alias("last_key"))
    return snapshot.resume_scan(table(spark, d, "orders"), "o_orderkey", PARTITIONS, progress).select("o_orderkey", "partition_id")


@query(f"SELECT CAST({EPOCH} AS BIGINT) AS event_time, CAST(o_orderkey AS VARCHAR) AS document_id, o_orderstatus AS full_document, 'insert' AS operation_type, '{DATABASE}' AS database, 'orders' AS collection, CAST({EPOCH} AS BIGINT) AS t, CAST(1 AS BIGINT) AS i, TRUE AS is_bootstrap, {hash_sql('o_orderkey')} AS partition_id, CAST(NULL AS BIGINT) AS token FROM orders")
def synthetic_insert(spark: SparkSession, d: str) -> DataFrame:
    rows = snapshot.synthetic_log(table(spark, d, "orders"), "o_orderkey", "o_orderstatus", EPOCH)
    return _flat(changes.to_messages(rows, DATABASE, "orders", PARTITIONS, bootstrap=True))


def _middle(spark: SparkSession, d: str) -> int:
    return (table(spark, d, "events").agg(F.max("event_id")).first()[0] or 0) // 2


_STATE = "SELECT doc_id, arg_max(document, token) AS document, arg_max(operation_type, token) AS op FROM routed WHERE {0} GROUP BY doc_id HAVING op <> 'delete'"


@query(f"""WITH {ROUTED}, mid AS (SELECT max(event_id) // 2 AS m FROM events), state AS ({_STATE.format('token < (SELECT m FROM mid)')})
SELECT doc_id AS document_id, document AS full_document, 'insert' AS operation_type, TRUE AS is_bootstrap, {hash_sql('doc_id')} AS partition_id, CAST(NULL AS BIGINT) AS token FROM state
UNION ALL SELECT doc_id, CASE WHEN operation_type <> 'delete' THEN document END, operation_type, FALSE, partition_id, token FROM routed WHERE token >= (SELECT m FROM mid)""")
def unified_feed(spark: SparkSession, d: str) -> DataFrame:
    middle, rows = _middle(spark, d), changes.filter_operations(fx.log(spark, d))
    state = feed.current_state(rows.filter(F.col("token") < middle))
    snap = changes.to_messages(snapshot.synthetic_log(state, "doc_id", "document", EPOCH), DATABASE, COLLECTION, PARTITIONS, bootstrap=True)
    after = changes.to_messages(rows.filter(F.col("token") >= middle), DATABASE, COLLECTION, PARTITIONS)
    return feed.unified(snap, after).select("document_id", "full_document", "operation_type", "is_bootstrap", "partition_id", "token")


@query(f"WITH {ROUTED}, state AS ({_STATE.format('TRUE')}) SELECT u.token, u.doc_id, s.document FROM routed u LEFT JOIN state s USING (doc_id) WHERE u.operation_type = 'update'")
def update_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = changes.filter_operations(fx.log(spark, d))
    return feed.look_up_updates(rows, feed.current_state(rows)).select("token", "doc_id", "document")


@query(f"WITH {ROUTED} SELECT operation_type, CAST(sum(n) AS BIGINT) AS total FROM (SELECT operation_type, count(*) AS n FROM routed GROUP BY 1 UNION ALL SELECT 'insert', count(*) FROM orders) GROUP BY 1")
def op_totals(spark: SparkSession, d: str) -> DataFrame:
    snap = snapshot.synthetic_log(table(spark, d, "orders"), "o_orderkey", "o_orderstatus", EPOCH)
    return metrics.operation_totals(changes.filter_operations(fx.log(spark, d)).select("operation_type").unionByName(snap.select("operation_type")))


@query(f"WITH {ROUTED} SELECT partition_id, max(token) AS token, arg_max(t, token) AS t, arg_max(i, token) AS i, count(*) AS acked FROM routed GROUP BY partition_id")
def latest_ack(spark: SparkSession, d: str) -> DataFrame:
    return checkpoints.latest_ack(_flat(_messages(spark, d)))


@query(f"WITH {ROUTED}, n AS (SELECT partition_id, token, (row_number() OVER (PARTITION BY partition_id ORDER BY token) - 1) // 50 AS batch FROM routed) SELECT partition_id, batch, max(token) AS saved FROM n GROUP BY 1, 2 HAVING count(*) = 50")
def stream_checkpoint_batches(spark: SparkSession, d: str) -> DataFrame:
    return checkpoints.commit_batches(fx.routed(spark, d).select("partition_id", "token"), "token", 50)


@query(f"WITH k AS (SELECT o_orderkey, {hash_sql('o_orderkey')} AS partition_id FROM orders), n AS (SELECT *, (row_number() OVER (PARTITION BY partition_id ORDER BY o_orderkey) - 1) // 250 AS batch FROM k) SELECT partition_id, batch, max(o_orderkey) AS saved FROM n GROUP BY 1, 2 HAVING count(*) = 250")
def bootstrap_checkpoint_batches(spark: SparkSession, d: str) -> DataFrame:
    return checkpoints.commit_batches(snapshot.scan(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", PARTITIONS), "o_orderkey", 250)


@query(f"WITH {ROUTED}, o AS (SELECT partition_id, min(token) AS open FROM routed WHERE token % 97 = 0 GROUP BY 1) SELECT r.partition_id, max(token) AS token FROM routed r LEFT JOIN o USING (partition_id) WHERE open IS NULL OR token < open GROUP BY 1")
def contiguous_commit(spark: SparkSession, d: str) -> DataFrame:
    return checkpoints.contiguous_commit(fx.routed(spark, d).select("partition_id", "token", (F.col("token") % 97 != 0).alias("acked")))


@query(f"WITH {CHECKPOINTS} SELECT partition_id, CASE WHEN bootstrap_last_id IS NOT NULL OR (resume_token IS NULL AND t IS NULL) THEN 'bootstrap' WHEN resume_token IS NOT NULL THEN 'resume_token' ELSE 'start_at_time' END AS start FROM checkpoints")
def start_state(spark: SparkSession, d: str) -> DataFrame:
    return feed.start_state(fx.checkpoints(spark, d)).select("partition_id", "start")


@query(f"WITH {CHECKPOINTS} SELECT r.partition_id, r.token, r.operation_type FROM routed r JOIN checkpoints c USING (partition_id) WHERE r.token > c.resume_token")
def resume_after_token(spark: SparkSession, d: str) -> DataFrame:
    return feed.resume_after(fx.routed(spark, d), fx.checkpoints(spark, d)).select("partition_id", "token", "operation_type")


@query(f"WITH {CHECKPOINTS} SELECT r.partition_id, r.token, r.t, r.i FROM routed r JOIN checkpoints c USING (partition_id) WHERE r.t > c.t OR (r.t = c.t AND r.i >= c.i)")
def start_at_operation_time(spark: SparkSession, d: str) -> DataFrame:
    return feed.start_at(fx.routed(spark, d), fx.checkpoints(spark, d)).select("partition_id", "token", "t", "i")


@query(f"WITH {CHECKPOINTS}, h AS (SELECT max(token) - 3050 AS head FROM log) SELECT partition_id, resume_token, head FROM checkpoints, h WHERE head > resume_token + 1")
def history_lost(spark: SparkSession, d: str) -> DataFrame:
    head = fx.log(spark, d).agg(F.max("token")).first()[0] - 3050
    return feed.history_lost(fx.checkpoints(spark, d), F.lit(head).cast("long")).select("partition_id", "resume_token", "head")


@query(f"WITH {CHECKPOINTS}, h AS (SELECT max(t) - 43200 AS head_t FROM log) SELECT partition_id, c.t, c.i, head_t, CAST(1 AS BIGINT) AS head_i FROM checkpoints c, h WHERE resume_token IS NULL AND c.t IS NOT NULL AND (c.t < head_t OR (c.t = head_t AND c.i < 1))")
def time_history_lost(spark: SparkSession, d: str) -> DataFrame:
    head = fx.now(spark, d).first()["now"] - 43200
    lost = feed.time_history_lost(fx.checkpoints(spark, d), F.lit(head).cast("long"), F.lit(1).cast("long"))
    return lost.select("partition_id", "t", "i", "head_t", "head_i")


_IDLE = f"{ROUTED}, last AS (SELECT partition_id, max(t) AS last_event FROM routed GROUP BY 1), clock AS (SELECT max(t) AS now FROM log), idle AS (SELECT partition_id, last_event FROM last, clock WHERE now - last_event > 1800)"


def _idle(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    now = fx.now(spark, d).first()["now"]
    latest = fx.routed(spark, d).groupBy("partition_id").agg(F.max("t").alias("last_event"))
    return checkpoints.idle(latest, now, 1800), now


@query(f"WITH {_IDLE} SELECT partition_id, last_event FROM idle")
def idle_partitions(spark: SparkSession, d: str) -> DataFrame:
    return _idle(spark, d)[0]


@query(f"WITH {_IDLE} SELECT partition_id, CAST(NULL AS BIGINT) AS resume_token, now AS t, CAST(1 AS BIGINT) AS i FROM idle, clock")
def highwatermark_advance(spark: SparkSession, d: str) -> DataFrame:
    rows, now = _idle(spark, d)
    writes = rows.select(F.lit(1).cast("long").alias("seq"), F.lit("advance").alias("kind"), "partition_id", F.lit(7).cast("long").alias("resume_token"), F.lit(now).cast("long").alias("t"), F.lit(1).cast("long").alias("i"), F.lit(None).cast("string").alias("bootstrap_last_id"))
    return checkpoints.fold_writes(writes).select("partition_id", "resume_token", "t", "i")


@query(f"WITH {ALIVE} SELECT worker_id, last_heartbeat FROM alive")
def active_workers(spark: SparkSession, d: str) -> DataFrame:
    return coordination.alive(fx.workers(spark, d), _cutoff(spark, d))


@query(f"WITH {ALIVE} SELECT count(*) AS n FROM alive")
def active_worker_count(spark: SparkSession, d: str) -> DataFrame:
    return coordination.alive(fx.workers(spark, d), _cutoff(spark, d)).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {ALIVE} SELECT worker_id, CAST(row_number() OVER (ORDER BY worker_id) - 1 AS INTEGER) AS worker_index FROM alive")
def worker_index(spark: SparkSession, d: str) -> DataFrame:
    return coordination.ranked(coordination.alive(fx.workers(spark, d), _cutoff(spark, d))).select("worker_id", "worker_index")


def _expected(spark: SparkSession, d: str) -> DataFrame:
    return coordination.expected(coordination.alive(fx.workers(spark, d), _cutoff(spark, d)), PARTITIONS)


@query(f"WITH {EXPECTED} SELECT worker_id, partition_id FROM expected")
def expected_assignment(spark: SparkSession, d: str) -> DataFrame:
    return _expected(spark, d)


@query("SELECT 'w-' || CAST(w AS VARCHAR) AS worker_id, CAST(p AS INTEGER) AS partition_id FROM range(0, 4) a(w), range(0, 15) b(p) WHERE p >= w * 3 + least(w, 3) AND p < (w + 1) * 3 + least(w + 1, 3)")
def expected_assignment_four(spark: SparkSession, d: str) -> DataFrame:
    return coordination.expected(spark.range(4).select(F.concat(F.lit("w-"), F.col("id").cast("string")).alias("worker_id")), PARTITIONS)


@query(f"WITH {WORKERS}, {ASSIGNMENTS} SELECT a.partition_id, a.worker_id FROM assignments a JOIN workers w USING (worker_id), clock WHERE w.last_heartbeat < now - {TIMEOUT_S}")
def dead_worker_release(spark: SparkSession, d: str) -> DataFrame:
    return coordination.owned_by(fx.assignments(spark, d), coordination.dead(fx.workers(spark, d), _cutoff(spark, d))).select("partition_id", "worker_id")


@query(f"WITH {WORKERS}, {ASSIGNMENTS} SELECT a.partition_id, a.worker_id FROM assignments a ANTI JOIN workers w USING (worker_id)")
def orphan_partitions(spark: SparkSession, d: str) -> DataFrame:
    return coordination.orphans(fx.assignments(spark, d), fx.workers(spark, d)).select("partition_id", "worker_id")


@query(f"WITH {EXPECTED}, {ASSIGNMENTS} SELECT e.worker_id, e.partition_id, a.worker_id IS NULL OR a.last_heartbeat < now - {TIMEOUT_S} OR a.worker_id = e.worker_id AS eligible FROM expected e LEFT JOIN assignments a USING (partition_id), clock")
def takeover_eligible(spark: SparkSession, d: str) -> DataFrame:
    held = fx.assignments(spark, d).withColumnRenamed("worker_id", "owner")
    rows = _expected(spark, d).join(held, "partition_id", "left")
    return rows.select("worker_id", "partition_id", coordination.can_take(F.col("owner"), F.col("last_heartbeat"), F.col("worker_id"), _cutoff(spark, d)).alias("eligible"))


@query(f"""WITH {EXPECTED}, {ASSIGNMENTS} SELECT partition_id, CASE WHEN take THEN me ELSE owner END AS worker_id FROM (
  SELECT partition_id, e.worker_id AS me, a.worker_id AS owner, e.worker_id IS NOT NULL AND (a.worker_id IS NULL OR a.last_heartbeat < now - {TIMEOUT_S} OR a.worker_id = e.worker_id) AS take
  FROM expected e FULL JOIN assignments a USING (partition_id), clock)""")
def acquire(spark: SparkSession, d: str) -> DataFrame:
    held = fx.assignments(spark, d).withColumn("assigned_at", F.col("last_heartbeat"))
    now = F.lit(fx.now(spark, d).first()["now"])
    return coordination.acquire(held, _expected(spark, d), now, _cutoff(spark, d)).select("partition_id", "worker_id")


@query(f"WITH {EXPECTED}, {ASSIGNMENTS} SELECT worker_id, partition_id, CASE WHEN a.h IS NULL THEN 'start' WHEN e.h IS NULL THEN 'stop' ELSE 'keep' END AS action FROM (SELECT worker_id, partition_id, 1 AS h FROM assignments) a FULL JOIN (SELECT *, 1 AS h FROM expected) e USING (worker_id, partition_id)")
def rebalance_diff(spark: SparkSession, d: str) -> DataFrame:
    return coordination.difference(fx.assignments(spark, d), _expected(spark, d))


@query(f"WITH {EXPECTED}, {ASSIGNMENTS} SELECT worker_id, partition_id FROM (SELECT worker_id, partition_id FROM assignments EXCEPT SELECT worker_id, partition_id FROM expected)")
def release_diff(spark: SparkSession, d: str) -> DataFrame:
    return coordination.difference(fx.assignments(spark, d), _expected(spark, d)).filter("action = 'stop'").drop("action")


@query(f"""WITH {EXPECTED}, {ASSIGNMENTS}, d AS (SELECT worker_id, count(*) AS n FROM (
  (SELECT worker_id, partition_id FROM assignments EXCEPT SELECT worker_id, partition_id FROM expected) UNION ALL (SELECT worker_id, partition_id FROM expected EXCEPT SELECT worker_id, partition_id FROM assignments)) GROUP BY 1)
SELECT worker_id, n IS NOT NULL AS needs_rebalance FROM alive LEFT JOIN d USING (worker_id)""")
def needs_rebalance(spark: SparkSession, d: str) -> DataFrame:
    living = coordination.alive(fx.workers(spark, d), _cutoff(spark, d))
    return coordination.needs_rebalance(living, fx.assignments(spark, d), _expected(spark, d), F.lit(False))


@query(f"WITH {EXPECTED}, {ASSIGNMENTS} SELECT e.worker_id, e.partition_id, coalesce(a.worker_id = e.worker_id, FALSE) AS is_mine FROM expected e LEFT JOIN assignments a USING (partition_id)")
def ownership_check(spark: SparkSession, d: str) -> DataFrame:
    rows = _expected(spark, d).join(fx.assignments(spark, d).withColumnRenamed("worker_id", "owner"), "partition_id", "left")
    return rows.select("worker_id", "partition_id", coordination.is_mine(F.col("owner"), F.col("worker_id")).alias("is_mine"))


def _rate_sql(source: str) -> str:
    return f"""{source}, c AS (SELECT operation_type, bucket, count(*) AS n FROM b GROUP BY 1, 2)
SELECT c.operation_type, c.bucket, CAST(sum(p.n) AS BIGINT) AS trailing, CAST(sum(p.n) AS DOUBLE) / 5 AS rate FROM c JOIN c p ON p.operation_type = c.operation_type AND p.bucket BETWEEN c.bucket - 4 AND c.bucket GROUP BY 1, 2"""


@query("WITH " + _rate_sql(f"{ROUTED}, b AS (SELECT operation_type, t // 3600 AS bucket FROM routed)"))
def op_rate(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.routed(spark, d).select("operation_type", F.expr("t DIV 3600").alias("bucket"))
    return metrics.trailing_rate(rows, "operation_type", "bucket")


@query("WITH " + _rate_sql(f"{ROUTED}, n AS (SELECT t, row_number() OVER (PARTITION BY partition_id ORDER BY token) AS n FROM routed), b AS (SELECT 'save' AS operation_type, t // 3600 AS bucket FROM n WHERE n % 50 = 0)"))
def checkpoint_rate(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.routed(spark, d).select("partition_id", "token", "t")
    saves = checkpoints.commit_batches(rows, "token", 50).select(F.col("saved").alias("token"))
    at = rows.join(saves, "token").select(F.lit("save").alias("operation_type"), F.expr("t DIV 3600").alias("bucket"))
    return metrics.trailing_rate(at, "operation_type", "bucket")


@query(f"WITH {ROUTED}, clock AS (SELECT max(t) AS now FROM log) SELECT partition_id, any_value(now) - max(t) AS event_lag FROM routed, clock GROUP BY 1")
def event_lag(spark: SparkSession, d: str) -> DataFrame:
    now = fx.now(spark, d).first()["now"]
    return fx.routed(spark, d).groupBy("partition_id").agg((F.lit(now) - F.max("t")).alias("event_lag"))


@query(f"WITH {CHECKPOINTS}, clock AS (SELECT max(t) AS now FROM log) SELECT CAST(p AS INTEGER) AS partition_id, coalesce(now - c.t, -1) AS time_since_checkpoint FROM range(0, {PARTITIONS}) r(p) LEFT JOIN checkpoints c ON c.partition_id = p, clock")
def time_since_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    now = fx.now(spark, d).first()["now"]
    ids = spark.range(PARTITIONS).select(F.col("id").cast("int").alias("partition_id"))
    return ids.join(fx.checkpoints(spark, d), "partition_id", "left").select("partition_id", F.coalesce(F.lit(now) - F.col("t"), F.lit(-1)).cast("long").alias("time_since_checkpoint"))


@query(f"WITH {ROUTED} SELECT partition_id, CAST(arg_max(token % 1000, token) AS DOUBLE) / 1000 AS cdc_latency FROM routed GROUP BY 1")
def cdc_latency(spark: SparkSession, d: str) -> DataFrame:
    ms = (F.col("token") % 1000).cast("double") / 1000
    return fx.routed(spark, d).groupBy("partition_id").agg(F.max_by(ms, "token").alias("cdc_latency"))


@query(f"WITH {ROUTED} SELECT 'tributary_' || operation_type || '_total' AS name, 'counter' AS type, CAST(count(*) AS DOUBLE) AS value FROM routed GROUP BY 1")
def metric_exposition(spark: SparkSession, d: str) -> DataFrame:
    return metrics.exposition(metrics.operation_totals(fx.routed(spark, d)))


@query(f"WITH {ROUTED}, g AS (SELECT doc_id AS consumer_group, CAST({PARTITIONS} + token % 3 AS INTEGER) AS configured, token FROM routed), f AS (SELECT consumer_group, arg_min(configured, token) AS stored FROM g GROUP BY 1) SELECT token, consumer_group, configured, stored, CASE WHEN configured = stored THEN 'ok' ELSE 'mismatch' END AS status FROM g JOIN f USING (consumer_group)")
def total_partition_guard(spark: SparkSession, d: str) -> DataFrame:
    starts = fx.routed(spark, d).select(F.col("doc_id").alias("consumer_group"), (F.lit(PARTITIONS) + F.col("token") % 3).cast("int").alias("configured"), "token")
    return coordination.guard_total(starts, "token")



_KINDS = ("save_token", "save_progress", "save_time", "clear_token", "clear_progress", "save_token", "save_token")
_WRITES = f"""{ROUTED}, w AS (SELECT token AS seq, partition_id, token % 7 AS k, CASE WHEN token % 7 IN (0, 5) THEN token END AS resume_token,
  CASE WHEN token % 7 IN (0, 2, 6) THEN t END AS t, CASE WHEN token % 7 IN (0, 2, 6) THEN i END AS i, CASE WHEN token % 7 = 1 THEN doc_id END AS bootstrap_last_id FROM routed)"""


def _writes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("token") % len(_KINDS)
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (k + 1).cast("int"))
    timed = k.isin(0, 2, 6)
    return fx.routed(spark, d).select(F.col("token").alias("seq"), kind.alias("kind"), "partition_id", F.when(k.isin(0, 5), F.col("token")).alias("resume_token"), F.when(timed, F.col("t")).alias("t"), F.when(timed, F.col("i")).alias("i"), F.when(k == 1, F.col("doc_id")).alias("bootstrap_last_id"))


@query(f"""WITH {_WRITES}, f AS (SELECT partition_id,
  CASE WHEN max(seq) FILTER (k IN (0, 5)) > coalesce(max(seq) FILTER (k = 3), -1) THEN max(seq) FILTER (k IN (0, 5)) END AS resume_token,
  CASE WHEN max(seq) FILTER (k IN (0, 2, 6)) > coalesce(max(seq) FILTER (k = 3), -1) THEN arg_max(t, seq) FILTER (k IN (0, 2, 6)) END AS t,
  CASE WHEN max(seq) FILTER (k IN (0, 2, 6)) > coalesce(max(seq) FILTER (k = 3), -1) THEN arg_max(i, seq) FILTER (k IN (0, 2, 6)) END AS i,
  CASE WHEN max(seq) FILTER (k = 1) > coalesce(max(seq) FILTER (k = 4), -1) THEN arg_max(bootstrap_last_id, seq) FILTER (k = 1) END AS bootstrap_last_id,
  CASE WHEN count(*) FILTER (k IN (0, 1, 4, 5, 6)) > 0 THEN arg_max(k = 1, seq) FILTER (k IN (0, 1, 4, 5, 6)) END AS is_bootstrapping FROM w GROUP BY 1) SELECT * FROM f""")
def checkpoint_upsert(spark: SparkSession, d: str) -> DataFrame:
    return checkpoints.fold_writes(_writes(spark, d)).drop("updated_seq")


@query(f"""WITH {_WRITES}, c AS (SELECT partition_id, max(seq) FILTER (k = 3) AS token_clear, max(seq) FILTER (k = 4) AS progress_clear FROM w GROUP BY 1),
s AS (SELECT w.* FROM w JOIN c USING (partition_id) WHERE seq <= greatest(coalesce(token_clear, -1), coalesce(progress_clear, -1)))
SELECT partition_id,
  CASE WHEN max(seq) FILTER (k IN (0, 5)) > coalesce(max(seq) FILTER (k = 3), -1) THEN max(seq) FILTER (k IN (0, 5)) END AS resume_token,
  CASE WHEN max(seq) FILTER (k IN (0, 2, 6)) > coalesce(max(seq) FILTER (k = 3), -1) THEN arg_max(t, seq) FILTER (k IN (0, 2, 6)) END AS t,
  CASE WHEN max(seq) FILTER (k IN (0, 2, 6)) > coalesce(max(seq) FILTER (k = 3), -1) THEN arg_max(i, seq) FILTER (k IN (0, 2, 6)) END AS i,
  CASE WHEN max(seq) FILTER (k = 1) > coalesce(max(seq) FILTER (k = 4), -1) THEN arg_max(bootstrap_last_id, seq) FILTER (k = 1) END AS bootstrap_last_id,
  max(seq) AS cleared_at FROM s GROUP BY 1""")
def checkpoint_clear(spark: SparkSession, d: str) -> DataFrame:
    """Each partition's row just after its last clear, which clears the fields of its kind and keeps the others."""
    writes = _writes(spark, d)
    last = writes.filter(F.col("kind").startswith("clear")).groupBy("partition_id").agg(F.max("seq").alias("cleared_at"))
    until = writes.join(last, "partition_id").filter("seq <= cleared_at")
    rows = checkpoints.fold_writes(until.drop("cleared_at")).join(last, "partition_id")
    return rows.select("partition_id", "resume_token", "t", "i", "bootstrap_last_id", "cleared_at")
