"""Consumer-group coordination over small tables: workers and assignments.

Times are columns of one type (timestamps in control tables); the cutoff is
passed in, so nothing here reads a clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def alive(workers: DataFrame, cutoff: Column) -> DataFrame:
    return workers.filter(F.col("last_heartbeat") >= cutoff)


def dead(workers: DataFrame, cutoff: Column) -> DataFrame:
    return workers.filter(F.col("last_heartbeat") < cutoff)


def ranked(workers: DataFrame) -> DataFrame:
    """Workers with their index (from 0) by id."""
    return workers.withColumn("worker_index", (F.row_number().over(Window.orderBy("worker_id")) - 1).cast("int"))


def expected(workers: DataFrame, partitions: int) -> DataFrame:
    """Contiguous ranges: each worker gets partitions // workers, the first ones one more; rows worker_id, partition_id."""
    n = F.count(F.lit(1)).over(Window.partitionBy())
    rows = ranked(workers).withColumn("n", n)
    base, extra = F.expr(f"{partitions} DIV n"), F.lit(partitions) % F.col("n")
    index = F.col("worker_index")
    start = index * base + F.least(index, extra)
    size = base + F.when(index < extra, 1).otherwise(0)
    ids = F.when(size > 0, F.sequence(start.cast("int"), (start + size - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    return rows.select("worker_id", F.explode(ids).alias("partition_id"))


def owned_by(assignments: DataFrame, workers: DataFrame) -> DataFrame:
    """Assignments whose worker is among ``workers``."""
    return assignments.join(workers.select("worker_id"), "worker_id", "left_semi")


def orphans(assignments: DataFrame, workers: DataFrame) -> DataFrame:
    """Assignments whose worker is unknown."""
    return assignments.join(workers.select("worker_id"), "worker_id", "left_anti")


def can_take(owner: Column, heartbeat: Column, me: Column, cutoff: Column) -> Column:
    """A partition is free, its owner's heartbeat is too old, or it is mine."""
    return owner.isNull() | (heartbeat < cutoff) | (owner == me)


def is_mine(owner: Column, me: Column) -> Column:
    return F.coalesce(owner == me, F.lit(False))


def difference(current: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per worker and partition: start (only wanted), stop (only current) or keep."""
    on = ["worker_id", "partition_id"]
    a, b = current.select(*on).withColumn("has", F.lit(True)), wanted.select(*on).withColumn("wants", F.lit(True))
    action = F.when(F.col("has").isNull(), "start").when(F.col("wants").isNull(), "stop").otherwise("keep")
    return a.join(b, on, "full").select(*on, action.alias("action"))


def needs_rebalance(workers: DataFrame, current: DataFrame, wanted: DataFrame, count_changed: Column) -> DataFrame:
    """Per worker: the number of workers changed, or its set of partitions isn't the expected one."""
    sets = lambda df: df.groupBy("worker_id").agg(F.collect_set("partition_id").alias("ids"))
    none = F.array().cast("array<int>")
    rows = workers.select("worker_id").join(sets(current).withColumnRenamed("ids", "now"), "worker_id", "left").join(sets(wanted), "worker_id", "left")
    rows = rows.withColumn("now", F.coalesce("now", none)).withColumn("ids", F.coalesce("ids", none))
    changed = (F.size(F.array_except("now", "ids")) > 0) | (F.size(F.array_except("ids", "now")) > 0)
    return rows.select("worker_id", (count_changed | changed).alias("needs_rebalance"))


def acquire(assignments: DataFrame, wanted: DataFrame, now: Column, cutoff: Column) -> DataFrame:
    """The assignment table after every worker has tried its wanted partitions: free, expired and own rows change hands."""
    rows = assignments.withColumnRenamed("worker_id", "owner").join(wanted.withColumnRenamed("worker_id", "me"), "partition_id", "full")
    taken = F.col("me").isNotNull() & can_take(F.col("owner"), F.col("last_heartbeat"), F.col("me"), cutoff)
    return rows.select("partition_id", F.when(taken, F.col("me")).otherwise(F.col("owner")).alias("worker_id"), F.when(taken, now).otherwise(F.col("assigned_at")).alias("assigned_at"), F.when(taken, now).otherwise(F.col("last_heartbeat")).alias("last_heartbeat"))


def guard_total(starts: DataFrame, order: str) -> DataFrame:
    """Worker starts (consumer_group, configured, order): the number of partitions a group's first start stored, and whether each agrees."""
    stored = starts.groupBy("consumer_group").agg(F.min_by("configured", order).alias("stored"))
    return starts.join(stored, "consumer_group").withColumn("status", F.when(F.col("configured") == F.col("stored"), "ok").otherwise("mismatch"))
