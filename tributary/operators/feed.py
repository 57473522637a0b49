"""Snapshot and changes as one feed, and where a partition starts in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current_state(log: DataFrame) -> DataFrame:
    """Live documents after a log: doc_id, document."""
    last = log.groupBy("doc_id").agg(F.max_by(F.struct("operation_type", "document"), "token").alias("last"))
    return last.filter("last.operation_type <> 'delete'").select("doc_id", "last.document")


def unified(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot messages and the changes since it began; the overlap is delivered twice."""
    return snapshot.unionByName(changes)


def look_up_updates(log: DataFrame, state: DataFrame) -> DataFrame:
    """Update events with the document as it is now (not as it was), null if it is gone."""
    updates = log.filter("operation_type = 'update'").drop("document")
    return updates.join(state.select("doc_id", "document"), "doc_id", "left")


def fill_updates(messages: DataFrame, state: DataFrame, small: bool = False) -> DataFrame:
    """Messages with the current document (document_id, document) in updates that came without one; ``small`` if ``state`` may be broadcast."""
    bare = (F.col("operation_type") == "update") & F.col("full_document").isNull()
    found = state.select("document_id", F.col("document").alias("__now"))
    joined = messages.join(F.broadcast(found) if small else found, "document_id", "left")
    return joined.withColumn("full_document", F.when(bare, F.col("__now")).otherwise(F.col("full_document"))).select(*messages.columns)


def should_bootstrap(token: Column, t: Column, last_id: Column) -> Column:
    """An unfinished snapshot wins over a token; without any progress there is one to take."""
    return last_id.isNotNull() | (token.isNull() & t.isNull())


def start_state(checkpoints: DataFrame) -> DataFrame:
    """Checkpoints (partition_id, resume_token, t, bootstrap_last_id) to how each partition starts."""
    boot = should_bootstrap(F.col("resume_token"), F.col("t"), F.col("bootstrap_last_id"))
    return checkpoints.withColumn("start", F.when(boot, "bootstrap").when(F.col("resume_token").isNotNull(), "resume_token").otherwise("start_at_time"))


def resume_after(routed: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Events after each partition's token; checkpoints have a row a partition."""
    saved = checkpoints.filter("resume_token IS NOT NULL").select("partition_id", "resume_token")
    return routed.join(F.broadcast(saved), "partition_id").filter("token > resume_token").drop("resume_token")


def start_at(routed: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Events at or after each partition's cluster time."""
    saved = checkpoints.filter("t IS NOT NULL").select("partition_id", F.struct("t", "i").alias("since"))
    return routed.join(F.broadcast(saved), "partition_id").filter(F.struct("t", "i") >= F.col("since")).drop("since")


def time_history_lost(checkpoints: DataFrame, t: Column, i: Column) -> DataFrame:
    """Partitions that start by time, from before the log's first entry, which was at (t, i)."""
    by_time = F.col("resume_token").isNull() & F.col("t").isNotNull()
    return checkpoints.filter(by_time & (F.struct(F.col("t"), F.col("i")) < F.struct(t.alias("t"), i.alias("i")))).withColumn("head_t", t).withColumn("head_i", i)


def history_lost(checkpoints: DataFrame, head: Column) -> DataFrame:
    """Partitions whose next event is older than the first one that the log retains."""
    return checkpoints.filter(F.col("resume_token").isNotNull() & (head > F.col("resume_token") + 1)).withColumn("head", head)


#: What a log server says when it can't go on from a token.
LOST_PHRASES = ("resume token was not found", "ChangeStreamFatalError", "cannot resume stream", "ChangeStreamHistoryLost")
LOST_TOGETHER = ("resume token", "invalid")


def says_history_lost(message: str | None) -> bool:
    """Whether an error's text means that resuming is impossible; sources without numbered tokens are told apart by it."""
    text = message or ""
    return any(p in text for p in LOST_PHRASES) or all(p in text for p in LOST_TOGETHER)


def history_lost_errors(errors: DataFrame, column: str = "message") -> DataFrame:
    """Rows of an error log that mean so."""
    found = [F.coalesce(F.col(column).contains(p), F.lit(False)) for p in LOST_PHRASES]
    both = F.coalesce(F.col(column).contains(LOST_TOGETHER[0]) & F.col(column).contains(LOST_TOGETHER[1]), F.lit(False))
    condition = both
    for f in found:
        condition = condition | f
    return errors.filter(condition)
