"""Acknowledgements to checkpoints, and the checkpoint table's partial updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.sequence import running_number


def latest_ack(messages: DataFrame) -> DataFrame:
    """Greatest token, its cluster time, and the count, per partition."""
    return messages.groupBy("partition_id").agg(F.max("token").alias("token"), F.max_by(F.struct("t", "i"), "token").alias("last"), F.count(F.lit(1)).alias("acked")).select("partition_id", "token", F.col("last.t").alias("t"), F.col("last.i").alias("i"), "acked")


def commit_batches(acks: DataFrame, order: str, every: int) -> DataFrame:
    """Full batches of ``every`` acks per partition: batch number (from 0) and the value of ``order`` that it saves."""
    numbered = running_number(acks, "partition_id", order, "n").withColumn("batch", F.floor((F.col("n") - 1) / every))
    full = numbered.groupBy("partition_id", "batch").agg(F.max(order).alias("saved"), F.count(F.lit(1)).alias("acks"))
    return full.filter(F.col("acks") == every).drop("acks")


def contiguous_commit(delivered: DataFrame) -> DataFrame:
    """Greatest token with no earlier token that isn't acked, per partition; rows have token and acked."""
    first_open = delivered.filter(~F.col("acked")).groupBy("partition_id").agg(F.min("token").alias("open"))
    before = delivered.join(F.broadcast(first_open), "partition_id", "left").filter(F.col("open").isNull() | (F.col("token") < F.col("open")))
    return before.groupBy("partition_id").agg(F.max("token").alias("token"))


#: Which fields each write to a checkpoint touches; what it doesn't touch stays.
TOUCHES = {
    "save_token": ("resume_token", "t", "i", "is_bootstrapping"),
    "save_progress": ("bootstrap_last_id", "is_bootstrapping"),
    "save_time": ("t", "i"),
    "advance": ("resume_token", "t", "i"),
    "clear_token": ("resume_token", "t", "i"),
    "clear_progress": ("bootstrap_last_id", "is_bootstrapping"),
}
FIELDS = ("resume_token", "t", "i", "bootstrap_last_id", "is_bootstrapping")


def normalise_writes(writes: DataFrame) -> DataFrame:
    """Writes (seq, kind, partition_id, resume_token, t, i, bootstrap_last_id) with the values that each kind sets.

    A token save without a value keeps the old one, and one without token and
    time does nothing. Advancing an idle partition by time drops its token, which
    would win at the next start.
    """
    kind = F.col("kind")
    empty = (kind == "save_token") & F.col("resume_token").isNull() & F.col("t").isNull()
    flag = F.when(kind == "save_progress", F.lit(True)).otherwise(F.lit(False))
    cleared = kind.isin("clear_token", "advance")
    rows = writes.filter(~empty).withColumn("is_bootstrapping", flag)
    rows = rows.withColumn("resume_token", F.when(~cleared, F.col("resume_token")))
    rows = rows.withColumn("t", F.when(kind != "clear_token", F.col("t"))).withColumn("i", F.when(kind != "clear_token", F.col("i")))
    return rows.withColumn("bootstrap_last_id", F.when(kind == "save_progress", F.col("bootstrap_last_id")))


def fold_writes(writes: DataFrame) -> DataFrame:
    """The checkpoint table after all writes: per field, the last write that touches it."""
    rows = normalise_writes(writes)
    kind = F.col("kind")

    def last(field: str):
        touching = [k for k, fields in TOUCHES.items() if field in fields]
        touched = kind.isin(*touching)
        if field in ("resume_token", "t", "i"):  # an absent part of a token save is not set
            touched = touched & ~((kind == "save_token") & F.col("resume_token" if field == "resume_token" else "t").isNull())
        return F.max_by(F.struct(F.col(field).alias("v")), F.when(touched, F.col("seq")))["v"].alias(field)

    return rows.groupBy("partition_id").agg(*[last(f) for f in FIELDS], F.max("seq").alias("updated_seq"))


def idle(latest: DataFrame, now, limit) -> DataFrame:
    """Partitions whose last event is older than ``limit``, strictly."""
    return latest.filter(F.lit(now) - F.col("last_event") > F.lit(limit))
