"""Mixture-controlled packing by deficit round-robin.

Sources are queues of documents. In each round a queue's deficit grows by its
quantum, its share of a window. It sends tokens once the deficit is a packet
(``PACKET`` tokens) or more, and then all that the deficit covers, so documents
are cut only where a deficit ends; the fraction of a token that is left is
carried on. Small queues, which save for m rounds, take turns: each starts with
the credit of up to m - 1 rounds. A queue's k-th packet thus ends at token
floor(k m quantum) and is sent in round k m - credit, so the schedule is a sort,
and deficits carry across windows and Spark partitions alike. Shares hold until
queues come to their last packet. The stream is cut every ``WINDOW`` tokens;
only the last sequence is padded.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tributary.llm.common import fresh_task, join_small, materialise, ordered_prefix, small_batches, task_id
from tributary.llm.wordids import default_path, encoder, gathered

WINDOW = 4096
#: A queue sends at least so many tokens at once, so a window misses a source's share by no more than about that.
PACKET = 256
END_ID = 2


def tokenise(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Materialised rows: row_id, doc_id, source, n_tokens, wide, ids (little-endian, 2 bytes each unless wide)."""
    small_batches(docs.sparkSession)
    tokenizer = tokenizer or default_path()
    tail = struct.pack("<I", end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task("wordids")
        words, row = encoder(tokenizer), task_id() << 33
        for (doc_id, source), texts in gathered(batches, 2):
            ids = [np.frombuffer(x + tail, "<u4") for x in words.ids(texts)]
            wide = [bool(x.max() > 0xFFFF) for x in ids]
            data = [(x if w else x.astype("<u2")).tobytes() for x, w in zip(ids, wide, strict=True)]
            n = len(texts)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + n)), doc_id, source, pa.array([len(x) for x in ids], pa.int64()), pa.array(wide), pa.array(data, pa.binary())], names=["row_id", "doc_id", "source", "n_tokens", "wide", "ids"])
            row += n

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.coalesce("text", F.lit("")))
    return materialise(rows.mapInArrow(encode, "row_id long, doc_id long, source string, n_tokens long, wide boolean, ids binary"), "ids", "zstd")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their packets (start, length, place in the stream) to pieces with ids."""
    fresh_task()
    for b in batches:
        out: dict[str, list] = {k: [] for k in PIECES.names}
        for doc_id, source, n, wide, data, packets in zip(*(b.column(k).to_pylist() for k in range(6)), strict=True):
            ids = np.frombuffer(data, "<u4" if wide else "<u2").astype("<u4", copy=False)
            for start, length, at in pieces(packets):
                out["doc_id"].append(doc_id)
                out["source"].append(source)
                out["start"].append(start)
                out["length"].append(length)
                out["doc_tokens"].append(n)
                out["sequence_id"].append(at // WINDOW)
                out["offset"].append(at % WINDOW)
                out["ids"].append(ids[start : start + length].tobytes())
            if len(out["ids"]) > 4096:
                yield pa.RecordBatch.from_pydict(out, schema=PIECES)
                out = {k: [] for k in PIECES.names}
        if out["ids"]:
            yield pa.RecordBatch.from_pydict(out, schema=PIECES)


PIECES = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


def pieces(packets: list[dict], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """A document's packets, joined where they follow each other in the stream, then cut at window ends: (start, length, place)."""
    runs: list[list[int]] = []
    for p in sorted(packets, key=lambda p: p["first"]):
        if runs and runs[-1][2] + runs[-1][1] == p["at"]:
            runs[-1][1] += p["length"]
        else:
            runs.append([p["first"], p["length"], p["at"]])
    out = []
    for start, length, at in runs:
        while length:
            n = min(length, window - at % window)
            out.append((start, n, at))
            start, length, at = start + n, length - n, at + n
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, weights: dict[str, float] | None = None, packet: int = PACKET) -> DataFrame:
    """Pack every token of every document (doc_id, text, source); one row per piece with its ids.

    Returns doc_id, source, start, length, doc_tokens, sequence_id, offset and
    ids (little-endian u32). Shares follow ``weights`` by source (others 1), or
    the sources' own tokens, so that all queues last equally long. Null or
    empty texts are the end id alone; null sources are one queue; equal rows
    are packed separately; an empty table gives no rows.
    """
    held = tokenise(docs, tokenizer)
    narrow = held.select("row_id", "doc_id", "source", "n_tokens")
    src = narrow.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    if weights:
        table = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
        src = src.withColumn("share", F.coalesce(table[F.col("source")], F.lit(1.0)))
    else:
        src = src.withColumn("share", F.col("tokens").cast("double"))
    whole = Window.partitionBy()
    src = src.select(F.col("source").alias("__source"), F.row_number().over(whole.orderBy(F.col("source").asc_nulls_last())).alias("queue"), (F.lit(float(WINDOW)) * F.col("share") / F.sum("share").over(whole)).alias("quantum"), "tokens")
    # rounds from packet to packet, those that a queue has credit of at first, and those after which it is empty
    src = src.withColumn("every", F.ceil(F.greatest(F.lit(1.0), packet / F.col("quantum")))).withColumn("credit", F.col("queue") % F.col("every")).withColumn("rounds", F.ceil(F.col("tokens") / F.col("quantum"))).drop("tokens")
    queued = join_small(narrow, src, F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "source")
    queued = queued.withColumn("mixed", F.xxhash64("doc_id"))
    queued = ordered_prefix(queued, ["mixed", "doc_id", "row_id"], "n_tokens", "before", "queue")
    # packets k that a document may have a part of, two to spare against rounding
    at = lambda place: F.floor(place / F.col("quantum") / F.col("every"))
    k = F.sequence(F.greatest(F.lit(1).cast("long"), at(F.col("before"))), at(F.col("before") + F.col("n_tokens")) + 2)
    parts = queued.select("row_id", "queue", "quantum", "before", "n_tokens", "rounds", "every", "credit", F.explode(k).alias("k"))
    ends = lambda k: F.floor(k * F.col("every") * F.col("quantum"))
    parts = parts.withColumn("place", F.greatest("before", ends(F.col("k") - 1)))
    parts = parts.withColumn("length", F.least(F.col("before") + F.col("n_tokens"), ends(F.col("k"))) - F.col("place")).filter("length > 0")
    sent = parts.select("row_id", (F.col("place") - F.col("before")).alias("first"), "length", "queue", "place", F.least("rounds", F.col("k") * F.col("every") - F.col("credit")).alias("round"))
    stream = ordered_prefix(sent, ["round", "queue", "place"], "length", "at")
    packets = stream.groupBy("row_id").agg(F.collect_list(F.struct("first", "length", "at")).alias("packets"))
    schema = T.StructType.fromDDL("doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    return held.join(packets, "row_id").select("doc_id", "source", "n_tokens", "wide", "ids", "packets").mapInArrow(_cut, schema)
