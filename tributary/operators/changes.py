"""Change events: filtering, decoding and projection to messages.

A log has columns token, doc_id, operation_type, document (JSON text or null),
t and i (cluster time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.hashing import partition_of
from tributary.schema import CHANGE_EVENT

#: The operations of the feed; all others are dropped at the source.
OPERATIONS = ("insert", "update", "delete", "replace")
#: Largest second that a cluster time can hold.
MOST_SECONDS = 4_294_967_295


def supported(operation: Column) -> Column:
    return operation.isin(*OPERATIONS)


def filter_operations(log: DataFrame) -> DataFrame:
    return log.filter(supported(F.col("operation_type")))


def reject_unsupported(log: DataFrame) -> DataFrame:
    """Events that the filter would let through by mistake, with a reason, for a dead-letter table."""
    known = F.coalesce(supported(F.col("operation_type")), F.lit(False))
    return log.filter(~known).withColumn("reason", F.concat(F.lit("unsupported operation type: "), F.coalesce("operation_type", F.lit("null"))))


def decode(raw: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON change events to (log, corrupt); corrupt rows go on as they came."""
    parsed = raw.withColumn("event", F.from_json(F.col(column), CHANGE_EVENT, {"mode": "PERMISSIVE"}))
    good = F.col("event.operation_type").isNotNull()
    log = parsed.filter(good).select(
        F.col("event.token").alias("token"), F.col("event.document_key._id").alias("doc_id"), F.col("event.operation_type").alias("operation_type"),
        F.col("event.full_document").alias("document"), F.col("event.cluster_time.t").alias("t"), F.col("event.cluster_time.i").alias("i"),
    )
    return log, parsed.filter(~F.coalesce(good, F.lit(False))).select(*raw.columns)


def clamp_seconds(seconds: Column) -> Column:
    return F.least(F.greatest(seconds, F.lit(0)), F.lit(MOST_SECONDS)).cast("long")


def to_messages(log: DataFrame, database: str, collection: str, partitions: int, bootstrap: bool = False) -> DataFrame:
    """Project supported events to messages; deletes carry no document, event time has whole seconds."""
    kept = filter_operations(log)
    return kept.select(
        F.timestamp_seconds("t").alias("event_time"), F.col("doc_id").alias("document_id"), F.when(F.col("operation_type") != "delete", F.col("document")).alias("full_document"),
        "operation_type", F.lit(database).alias("database"), F.lit(collection).alias("collection"), F.struct("t", "i").alias("cluster_time"),
        F.lit(bootstrap).alias("is_bootstrap"), partition_of(F.col("doc_id"), partitions).alias("partition_id"), "token",
    )


def is_insert(operation: Column) -> Column:
    return operation == "insert"


def is_update(operation: Column) -> Column:
    return operation == "update"


def is_delete(operation: Column) -> Column:
    return operation == "delete"


def is_replace(operation: Column) -> Column:
    return operation == "replace"
