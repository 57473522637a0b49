"""The test tables seen as a change log, collections, checkpoints and a consumer group.

Each view is here twice: as a frame, and as a SQL common table expression with
the same columns, for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.functions.hashing import partition_of

PARTITIONS = 15
DATABASE, COLLECTION = "shop", "events"
OPS = {"signup": "insert", "click": "update", "purchase": "replace", "error": "delete"}
TIMEOUT_S = 6 * 3600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(column: str = "ts"):
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})").cast("long")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a change log: views are an operation that the feed doesn't have."""
    op = F.lit("drop")
    for event, name in OPS.items():
        op = F.when(F.col("event_type") == event, name).otherwise(op)
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("token"), F.col("user_id").cast("string").alias("doc_id"), op.alias("operation_type"), F.col("props").alias("document"), seconds().alias("t"))
    return rows.withColumn("i", F.row_number().over(Window.partitionBy("t").orderBy("token")).cast("long"))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supported part of the log with its partitions."""
    return log(spark, sf_dir).filter(F.col("operation_type").isin(*OPS.values())).withColumn("partition_id", partition_of(F.col("doc_id"), PARTITIONS))


def workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as workers, last seen at their last event, in seconds."""
    return table(spark, sf_dir, "events").groupBy(F.concat(F.lit("w-"), F.col("user_id").cast("string")).alias("worker_id")).agg(F.max(seconds()).alias("last_heartbeat"))


def now(spark: SparkSession, sf_dir: str):
    """The group's clock: the last second of the log, as a one-row frame."""
    return table(spark, sf_dir, "events").agg(F.max(seconds()).alias("now"))


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition p belongs to worker 13 p mod 170, which may not exist; partitions divisible by 7 are free."""
    ids = spark.range(PARTITIONS).filter("id % 7 <> 0").select(F.col("id").cast("int").alias("partition_id"), F.concat(F.lit("w-"), (F.col("id") * 13 % 170).cast("string")).alias("worker_id"))
    seen = workers(spark, sf_dir)
    return ids.join(seen, "worker_id", "left").select("partition_id", "worker_id", F.coalesce("last_heartbeat", F.lit(0).cast("long")).alias("last_heartbeat"))


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved state a partition: by p mod 5 none, token, time, both, or an unfinished snapshot."""
    acked = routed(spark, sf_dir).filter("token % 3 = 0").groupBy("partition_id").agg(F.max("token").alias("token"), F.max_by(F.struct("t", "i"), "token").alias("c"))
    kind = F.col("partition_id") % 5
    return acked.select(
        "partition_id", F.when(kind.isin(1, 3, 4), F.col("token") - 3000).alias("resume_token"), F.when(kind.isin(2, 3), F.col("c.t") - 86400).alias("t"), F.when(kind.isin(2, 3), F.col("c.i")).alias("i"),
        F.when(kind == 4, F.concat(F.lit("k-"), F.col("partition_id").cast("string"))).alias("bootstrap_last_id"),
    )


_HASH = "CAST(CAST('0x' || substr(md5(CAST({0} AS VARCHAR)), 1, 15) AS BIGINT) % " + str(PARTITIONS) + " AS INTEGER)"


def hash_sql(column: str) -> str:
    return _HASH.format(column)


LOG = """log AS (
  SELECT event_id AS token, CAST(user_id AS VARCHAR) AS doc_id,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'click' THEN 'update' WHEN 'purchase' THEN 'replace' WHEN 'error' THEN 'delete' ELSE 'drop' END AS operation_type,
         props AS document, CAST(floor(epoch(ts)) AS BIGINT) AS t,
         row_number() OVER (PARTITION BY CAST(floor(epoch(ts)) AS BIGINT) ORDER BY event_id) AS i FROM events)"""
ROUTED = f"{LOG}, routed AS (SELECT *, {hash_sql('doc_id')} AS partition_id FROM log WHERE operation_type <> 'drop')"
WORKERS = "workers AS (SELECT 'w-' || CAST(user_id AS VARCHAR) AS worker_id, max(CAST(floor(epoch(ts)) AS BIGINT)) AS last_heartbeat FROM events GROUP BY 1), clock AS (SELECT max(CAST(floor(epoch(ts)) AS BIGINT)) AS now FROM events)"
ALIVE = f"{WORKERS}, alive AS (SELECT w.* FROM workers w, clock WHERE last_heartbeat >= now - {TIMEOUT_S})"
EXPECTED = f"""{ALIVE}, ranked AS (SELECT worker_id, row_number() OVER (ORDER BY worker_id) - 1 AS idx, count(*) OVER () AS n FROM alive),
  expected AS (SELECT worker_id, CAST(p AS INTEGER) AS partition_id FROM ranked, range(0, {PARTITIONS}) AS r(p)
    WHERE p >= idx * ({PARTITIONS} // n) + least(idx, {PARTITIONS} % n) AND p < (idx + 1) * ({PARTITIONS} // n) + least(idx + 1, {PARTITIONS} % n))"""
ASSIGNMENTS = f"""assignments AS (SELECT CAST(p AS INTEGER) AS partition_id, 'w-' || CAST(p * 13 % 170 AS VARCHAR) AS worker_id, coalesce(last_heartbeat, 0) AS last_heartbeat
  FROM range(0, {PARTITIONS}) AS r(p) LEFT JOIN workers ON worker_id = 'w-' || CAST(p * 13 % 170 AS VARCHAR) WHERE p % 7 <> 0)"""
CHECKPOINTS = f"""{ROUTED}, acked AS (SELECT partition_id, max(token) AS token, arg_max(t, token) AS t, arg_max(i, token) AS i FROM routed WHERE token % 3 = 0 GROUP BY 1),
  checkpoints AS (SELECT partition_id, CASE WHEN partition_id % 5 IN (1, 3, 4) THEN token - 3000 END AS resume_token,
    CASE WHEN partition_id % 5 IN (2, 3) THEN t - 86400 END AS t, CASE WHEN partition_id % 5 IN (2, 3) THEN i END AS i,
    CASE WHEN partition_id % 5 = 4 THEN 'k-' || CAST(partition_id AS VARCHAR) END AS bootstrap_last_id FROM acked)"""
