"""Sharding along a Hilbert curve over document metadata.

Each dimension is quantised to a few bits, the cell's place on the curve is
the sort key, and the sorted rows are cut into runs whose counts differ by at
most one. Rows near each other on the curve are near in every dimension, so a
file's min/max statistics prune on any of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import join_small, materialise, ordered_prefix, scratch_path

BITS = 5


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of cells (rows x dimensions, each 0 to 2**bits - 1): Skilling's transform, all rows at once."""
    x = [c.astype(np.int64) for c in np.asarray(cells).T]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for k in range(len(x)):
            up = (x[k] >> level & 1).astype(bool)
            swap = np.where(up, 0, (x[0] ^ x[k]) & low)
            x[0] ^= np.where(up, low, swap)
            if k:
                x[k] ^= swap
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    out = np.zeros_like(flip)
    for level in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | ((v ^ flip) >> level & 1)
    return out


def _curve(bits: int):
    @F.pandas_udf("long")
    def curve(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(), bits))

    return curve


def _by_rank(df: DataFrame, column: str, cell: str, bits: int) -> DataFrame:
    """Quantise a text column to its place among the distinct values, null last; however many there are, no task ranks them all."""
    values = df.groupBy(column).agg(F.lit(1).cast("long").alias("__one")).withColumn("__null", F.col(column).isNull())
    places = materialise(ordered_prefix(values, ["__null", column], "__one", "__rank").select(F.col(column).alias("__value"), "__rank"), "places")
    joined = join_small(df, places, F.col(column).eqNullSafe(F.col("__value")))
    return joined.withColumn(cell, F.floor(F.col("__rank") * (1 << bits) / F.lit(places.count())).cast("int")).drop("__value", "__rank")


def linear_cell(value: Column, low: Column, high: Column, bits: int) -> Column:
    """Equal-width cells between the least and greatest value; null is in the first."""
    x = (value.cast("double") - low.cast("double")) / (high.cast("double") - low.cast("double") + F.lit(1.0)) * F.lit(float(1 << bits))
    return F.coalesce(F.least(F.floor(x).cast("int"), F.lit((1 << bits) - 1)), F.lit(0))


def place(docs: DataFrame, shards: int, bits: int = BITS) -> DataFrame:
    """Assign documents (doc_id, text, lang, source) to shards.

    Returns doc_id, size (UTF-8 bytes and 8), text_crc32, law, shard, slot
    (gapless from 0 along the curve), grown_shard (null: the law is 'rows') and
    hilbert. Dimensions: language and source by rank, size by its binary
    length, doc_id in equal-width cells. The text itself is not shuffled. Ties
    on the curve are ordered by doc_id, size and crc. Null texts are empty; null
    values of a dimension have a cell of their own or the first; equal rows are
    separate; an empty table gives no rows.
    """
    placed = _placed(docs.select("doc_id", "text", "lang", "source", F.lit(0).cast("long").alias("__at")), shards, bits)
    return placed.drop("__at")


def _placed(docs: DataFrame, shards: int, bits: int) -> DataFrame:
    """As place(), with the column ``__at`` of the input."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("__at", F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    rows = materialise(rows, "shard-meta")
    ends = rows.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    n = ends["n"]
    cells = _by_rank(_by_rank(rows, "lang", "c_lang", bits), "source", "c_source", bits)
    cells = cells.withColumn("c_size", F.least(F.length(F.bin("size")) - 1, F.lit((1 << bits) - 1)))
    cells = cells.withColumn("c_id", linear_cell(F.col("doc_id"), F.lit(ends["low"]).cast("long"), F.lit(ends["high"]).cast("long"), bits))
    curve = _curve(bits)(F.struct("c_lang", "c_source", "c_size", "c_id"))
    keyed = cells.select("__at", "doc_id", "size", "text_crc32", curve.alias("hilbert"), F.lit(1).cast("long").alias("one"))
    ranked = ordered_prefix(keyed, ["hilbert", "doc_id", "size", "text_crc32"], "one", "rank")
    shard = F.expr(f"CAST(rank * {shards} DIV {max(n, 1)} AS INT)")
    return ranked.withColumn("shard", shard).select("__at", "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.expr(f"rank - (shard * CAST({n} AS BIGINT) + {shards - 1}) DIV {shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def write(docs: DataFrame, path: str | None = None, shards: int = 24) -> str:
    """Write the documents themselves as one folder per shard, in curve order; returns the path.

    All columns are kept. Rows meet their shard by a number of their own, so
    repeated documents stay apart, however many there are. Nulls are as in
    place(); an empty table gives a folder without rows.
    """
    path = path or scratch_path(docs.sparkSession, "shards")
    rows = materialise(docs.select(F.struct("*").alias("__row"), F.monotonically_increasing_id().alias("__at")), "documents")
    named = rows.select("__at", *[F.col(f"__row.{c}").alias(c) for c in ("doc_id", "text", "lang", "source")])
    placed = _placed(named, shards, BITS).select("__at", F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))
    out = rows.join(placed, "__at").select("__row.*", "__shard", "__slot")
    out.repartitionByRange(shards, "__shard").sortWithinPartitions("__shard", "__slot").write.partitionBy("__shard").parquet(path)
    return path
