"""Metrics from frames: totals, rates, lags and the exposition table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def operation_totals(messages: DataFrame) -> DataFrame:
    """Count per operation; snapshot rows are inserts."""
    return messages.groupBy("operation_type").agg(F.count(F.lit(1)).alias("total"))


def trailing_rate(events: DataFrame, key: str, bucket: str, width: int = 5) -> DataFrame:
    """Events per bucket over the ``width`` buckets that end at each bucket with events, per key.

    ``bucket`` is an integer; each event counts in the next ``width`` buckets,
    after it has been added up with the others of its bucket.
    """
    counts = events.groupBy(key, bucket).agg(F.count(F.lit(1)).alias("n"))
    spread = counts.select(key, F.explode(F.sequence(F.col(bucket), F.col(bucket) + width - 1)).alias(bucket), "n").groupBy(key, bucket).agg(F.sum("n").alias("trailing"))
    return counts.join(spread, [key, bucket]).select(key, bucket, "trailing", (F.col("trailing") / width).alias("rate"))


def exposition(totals: DataFrame, prefix: str = "tributary") -> DataFrame:
    """Counters as (name, type, value) rows."""
    name = F.concat(F.lit(f"{prefix}_"), F.col("operation_type"), F.lit("_total"))
    return totals.select(name.alias("name"), F.lit("counter").alias("type"), F.col("total").cast("double").alias("value"))
