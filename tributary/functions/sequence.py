"""Numbering rows in order without putting a key's rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running_number(df: DataFrame, key: str, order: str, name: str, width: int = 100_000) -> DataFrame:
    """Append ``name``: the row's number (from 1) within ``key`` by the integer column ``order``.

    Rows are numbered within ranges of ``order``, ``width`` wide; a key's counts
    of earlier ranges are added. Only one row per key and range is summed up
    over a whole key.
    """
    rows = df.withColumn("__range", F.floor(F.col(order) / width))
    counts = rows.groupBy(key, "__range").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    numbered = rows.join(offsets, [key, "__range"])
    inside = F.row_number().over(Window.partitionBy(key, "__range").orderBy(order))
    return numbered.withColumn(name, F.col("__offset") + inside).drop("__range", "__offset")


def merge_latest(current: DataFrame, changes: DataFrame, key: str, version: Column | str) -> DataFrame:
    """Keyed upsert: the row of greatest version for each key of either side."""
    columns = current.columns
    both = current.unionByName(changes.select(*columns))
    newest = both.groupBy(key).agg(F.max_by(F.struct(*columns), version).alias("row"))
    return newest.select("row.*")
