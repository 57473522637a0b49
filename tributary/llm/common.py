"""What the operators of this subpackage share: scratch tables in the folder
that all executors see, bounded broadcasts, ordered running sums, words."""

from __future__ import annotations

import ctypes
import re
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: A word: a longest run of bytes that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a table that may be broadcast; beyond that joins shuffle.
BROADCAST_ROWS = 200_000
#: Bytes of text that Python code handles at once.
CHUNK_BYTES = 4 << 20

_scratch: list[tuple[object, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where it is unset, a local session gets one; a cluster must name it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tributary-")
        spark.conf.set("spark.checkpoint.dir", base)
        delete_on_exit(spark, base)
    return base.rstrip("/")


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Delete a written path when the session's JVM ends."""
    p, fs = _path(spark, path)
    fs.deleteOnExit(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed by release() or at the session's end."""
    path = f"{shared_dir(spark)}/tributary-{name}-{uuid.uuid4().hex}"
    (_staged.append(path) if getattr(_in_stage, "yes", False) else _scratch.append((spark, path)))
    return path


def release(spark: SparkSession) -> None:
    """Delete the scratch tables made so far. Frames that still read them stop working."""
    kept = []
    for owner, path in _scratch:
        if owner is spark or owner.sparkContext is spark.sparkContext:
            p, fs = _path(spark, path)
            fs.delete(p, True)
        else:
            kept.append((owner, path))
    _scratch[:] = kept


_staged: list[str] = []
_in_stage = threading.local()


@contextmanager
def stage_scratch() -> Iterator[None]:
    """Scratch tables made inside belong to one pipeline stage."""
    _in_stage.yes = True
    try:
        yield
    finally:
        _in_stage.yes = False


def release_stages(spark: SparkSession) -> None:
    """Delete the scratch tables of earlier stages, whose results have been written."""
    for path in _staged:
        p, fs = _path(spark, path)
        fs.delete(p, True)
    _staged.clear()


def materialise(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_batches(spark: SparkSession, rows: int = 2048, most: int = CHUNK_BYTES) -> None:
    """Hand whole texts to Python in batches of few rows and bytes."""
    for key, value in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", most)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{key}")
        if not str(now).isdigit() or int(now) > value or int(now) <= 0:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(value))


def join_small(left: DataFrame, right: DataFrame, on, how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join to a table that is broadcast if it has few rows, and shuffled (AQE splits skew) otherwise."""
    if right.limit(rows + 1).count() <= rows:
        right = F.broadcast(right)
    return left.join(right, on, how)


def crc_mod(col: str, mod: int) -> Column:
    """crc32 of the column as text, modulo; a null counts as the text ''."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def n_words(col: str) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")


#: What Python workers keep from task to task, by the operator that it serves.
KEPT: dict[str, dict] = {}


def fresh_task(keeps: str = "") -> None:
    """Called first in a Python task: workers are reused from stage to stage, so what others have kept or freed is given back."""
    for name, kept in KEPT.items():
        if name != keeps:
            kept.clear()
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def _find_libc() -> ctypes.CDLL | None:
    try:
        libc = ctypes.CDLL("libc.so.6")
        return libc if hasattr(libc, "malloc_trim") else None
    except OSError:
        return None


_libc = _find_libc()


def task_id() -> int:
    return TaskContext.get().partitionId()


def ordered_prefix(df: DataFrame, order: list[str | Column], value: str, before: str, group: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``before``: the sum of ``value`` over all earlier rows in ``order``, within ``group`` if given.

    A range shuffle on (group, order) deals the rows out evenly, however large
    one group is; each task sums its own rows and only one total per task and
    group goes on, so no task and no driver ever holds a group. ``value`` and
    ``group`` must not be null. The result is materialised.
    """
    spark = df.sparkSession
    keys = ([F.col(group)] if group else []) + [F.col(k) if isinstance(k, str) else k for k in order]
    schema = T.StructType([*df.schema.fields, T.StructField("__pid", T.IntegerType()), T.StructField("__local", T.LongType())])
    arrow_group = group

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        pid, last, base = task_id(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column(b.schema.get_field_index(value)).to_numpy(zero_copy_only=False).astype(np.int64)
            cum = np.cumsum(v) - v
            if arrow_group:
                g = b.column(b.schema.get_field_index(arrow_group)).to_numpy(zero_copy_only=False)
                new = np.r_[g[0] != last, g[1:] != g[:-1]]
                starts = np.maximum.accumulate(np.where(new, np.arange(len(g)), -1))
                local = np.where(starts < 0, cum + base, cum - cum[np.maximum(starts, 0)])
                last = g[-1]
            else:
                local = cum + base
            base = int(local[-1] + v[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, pid, np.int32)), pa.array(local.astype(np.int64))], names=[*b.schema.names, "__pid", "__local"])

    n = partitions or shuffle_partitions(spark)
    local = materialise(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).mapInArrow(running, schema), "prefix")
    by = ["__pid", group] if group else ["__pid"]
    totals = local.groupBy(*by).agg(F.sum(value).alias("__total"))
    w = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, F.coalesce(F.sum("__total").over(w), F.lit(0)).alias("__offset"))
    return join_small(local, offsets, by).withColumn(before, F.col("__offset") + F.col("__local")).drop("__pid", "__local", "__offset")


# --- texts in Python -------------------------------------------------------


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def groups_of(texts: Iterable[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``most`` bytes together."""
    at, size, i = 0, 0, -1
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t)
    if i >= at:
        yield at, i + 1


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def slices(text: bytes, most: int = CHUNK_BYTES) -> Iterator[bytes]:
    """A text in pieces that end at white space, each about ``most`` bytes (more only for a longer word)."""
    at = 0
    while len(text) - at > most:
        m = _SPACE.search(text, at + most)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text
