"""Token-id output in directly addressable codes.

An id is split into bytes, lowest first. Level k holds byte k of every id that
has one; a bitmap beside it says which of its ids go on to level k+1, and a
rank directory counts the set bits before each block of 512, so id i is found
without decoding any other: its place in level k+1 is the rank of its bit.

File format, little-endian: ``DAC1``, u32 levels, u64 ids; then per level u64
length n, n bytes, the bitmap of ceil(n/8) bytes (lowest bit first), and the
directory of ceil(n/512) u64 ranks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import join_small, shuffle_partitions, small_batches, task_id
from tributary.llm.wordids import default_path, encoder, gathered

MAGIC = b"DAC1"
BLOCK = 512
#: A shard is closed once it holds so many ids; documents are not cut.
SHARD_IDS = 1 << 20
#: Public end-of-document id.
END_ID = 2


def encode(ids: np.ndarray) -> bytes:
    """One shard of the file format for unsigned 32-bit ids."""
    rest = np.asarray(ids, np.uint32)
    levels = []
    while len(rest):
        more = rest > 0xFF
        bitmap = np.packbits(more, bitorder="little")
        ranks = np.r_[0, np.cumsum(np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint64))[:-1]].astype("<u8")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bitmap.tobytes() + ranks.tobytes())
        rest = rest[more] >> 8
    return MAGIC + struct.pack("<IQ", len(levels), len(ids)) + b"".join(levels)


class Shard:
    """A shard opened for reading."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a DAC1 shard")
        n_levels, self.n = struct.unpack_from("<IQ", data, 4)
        self.levels, at = [], 16
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            low = np.frombuffer(data, np.uint8, n, at)
            at += n
            bitmap = np.frombuffer(data, np.uint8, -(-n // 8), at)
            at += len(bitmap)
            ranks = np.frombuffer(data, "<u8", -(-n // BLOCK), at)
            at += 8 * len(ranks)
            self.levels.append((low, bitmap, ranks))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """Id i, by one look-up per level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, (low, bitmap, ranks) in enumerate(self.levels):
            value |= int(low[i]) << (8 * k)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(bitmap, ranks, i)
        return value

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, i: int) -> int:
        start = i // BLOCK
        inside = bitmap[start * BLOCK >> 3 : i >> 3]
        last = int(bitmap[i >> 3]) & ((1 << (i & 7)) - 1)
        return int(ranks[start]) + int(np.bitwise_count(inside).sum()) + last.bit_count()

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop (exclusive), reading only those codes."""
        start, stop = max(0, start), min(self.n, stop)
        out = np.zeros(max(0, stop - start), np.uint32)
        where, at = np.arange(len(out)), start
        for k, (low, bitmap, ranks) in enumerate(self.levels):
            n = len(where)
            if not n:
                break
            out[where] |= low[at : at + n].astype(np.uint32) << np.uint32(8 * k)
            first = at >> 3
            bits = np.unpackbits(bitmap[first : (at + n + 7) >> 3], bitorder="little")[at - 8 * first :][:n].astype(bool)
            where = where[bits]
            if len(where):
                at = self._rank(bitmap, ranks, at)
        return out


SCHEMA = "part int, seq int, shard_start long, n_tokens long, shard binary, docs array<struct<doc_id: long, n_tokens: long>>"


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode every whole text in ascending doc_id order and write shards to ``path``.

    The container is Parquet, so any store that Spark writes will do; each row
    is one shard in the format above with the documents it holds. Null and
    empty texts are the end id alone; null doc_ids come first; rows of equal
    doc_id are ordered by a hash of the text. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tokenizer = tokenizer or default_path()
    tail = struct.pack("<I", end_id)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "doc_id", tie).sortWithinPartitions("doc_id", tie)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, seq, start, held, index, n = encoder(tokenizer), task_id(), 0, 0, [], [], 0

        def close() -> pa.RecordBatch:
            shard = encode(np.frombuffer(b"".join(held), "<u4"))
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "shard_start": start, "n_tokens": n, "shard": shard, "docs": index}], schema=out)

        for (doc_ids,), texts in gathered(batches, 1):
            for doc_id, ids in zip(doc_ids.to_pylist(), words.ids(texts), strict=True):
                held += (ids, tail)
                size = len(ids) // 4 + 1
                index.append({"doc_id": doc_id, "n_tokens": size})
                n += size
                if n >= shard_ids:
                    yield close()
                    seq, start, held, index, n = seq + 1, start + n, [], [], 0
        if index:
            yield close()

    out = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("shard_start", pa.int64()), ("n_tokens", pa.int64()), ("shard", pa.binary()), ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64())])))])
    ordered.mapInArrow(shards, SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written folder: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian u32)."""
    return _read(spark, path, lambda ids: ids.tobytes(), "ids binary", pa.binary())


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """As read(), with the ids' unsigned crc32 in place of the ids."""
    return _read(spark, path, lambda ids: zlib.crc32(ids.tobytes()), "ids_crc32 long", pa.int64())


def _read(spark: SparkSession, path: str, what, column: str, kind: pa.DataType) -> DataFrame:
    files = spark.read.schema(SCHEMA).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    name = column.split()[0]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, start, data, docs in zip(b.column(0), b.column(1), b.column(2), b.column(3), strict=True):
                shard, inner = Shard(data.as_py()), start.as_py()
                ids = docs.values.field("doc_id") if len(docs) else pa.array([], pa.int64())
                sizes = docs.values.field("n_tokens").to_numpy(zero_copy_only=False)
                starts = np.cumsum(sizes) - sizes
                for i in range(0, len(sizes), 4096):
                    k = slice(i, i + 4096)
                    end = int(starts[k][-1] + sizes[k][-1])
                    block, first = shard.range(int(starts[i]), end), int(starts[i])
                    values = [what(block[s - first : s - first + n]) for s, n in zip(starts[k].tolist(), sizes[k].tolist(), strict=True)]
                    m = len(values)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(m, part.as_py(), np.int32)), ids[k], pa.array(starts[k] + inner), pa.array(sizes[k]), pa.array(values, kind)], names=["part", "doc_id", "inner", "n_tokens", name])

    read_ = files.select("part", "shard_start", "shard", "docs").mapInArrow(documents, f"part int, doc_id long, inner long, n_tokens long, {column}")
    return join_small(read_, offsets, "part").select("doc_id", (F.col("offset") + F.col("inner")).alias("start"), "n_tokens", name)
