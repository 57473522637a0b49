"""The snapshot: a keyset-resumable scan whose rows become insert messages.

The scan is one pass that derives the partition of each row; reading one
partition is a filter on it. The key stays typed for ordering and resuming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.hashing import partition_of
from tributary.operators.changes import clamp_seconds


def scan(collection: DataFrame, key: str, partitions: int, after: object = None, only: list[int] | None = None) -> DataFrame:
    """Rows after the key ``after``, with partition_id, in the given partitions (all by default)."""
    rows = collection if after is None else collection.filter(F.col(key) > F.lit(after))
    rows = rows.withColumn("partition_id", partition_of(F.col(key), partitions))
    return rows if only is None else rows.filter(F.col("partition_id").isin(*only))


def resume_scan(collection: DataFrame, key: str, partitions: int, progress: DataFrame) -> DataFrame:
    """As scan(), each partition after its own last key; ``progress`` (partition_id, last_key) has a row a partition at most."""
    rows = scan(collection, key, partitions)
    return rows.join(F.broadcast(progress), "partition_id", "left").filter(F.col("last_key").isNull() | (F.col(key) > F.col("last_key"))).drop("last_key")


def synthetic_log(collection: DataFrame, key: str, document: str, started: int) -> DataFrame:
    """Snapshot rows as insert events at the (clamped) second at which the snapshot started; they have no token."""
    return collection.select(
        F.lit(None).cast("long").alias("token"), F.col(key).cast("string").alias("doc_id"), F.lit("insert").alias("operation_type"),
        F.col(document).alias("document"), clamp_seconds(F.lit(started)).alias("t"), F.lit(1).cast("long").alias("i"),
    )
