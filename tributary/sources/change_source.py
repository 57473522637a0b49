"""Sources of documents and their changes."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from tributary.operators.changes import decode
from tributary.schema import TEXT, WHOLE, struct

#: What a change log has: see tributary.operators.changes.
LOG = struct(token=WHOLE, doc_id=TEXT, operation_type=TEXT, document=TEXT, t=WHOLE, i=WHOLE)


class ChangeSource(Protocol):
    key: str

    def check(self) -> None:
        """Raise if the source can't give an ordered change log."""

    def snapshot(self) -> DataFrame:
        """The collection as it is: the key and a document column."""

    def changes(self, after: int | None) -> DataFrame:
        """A streaming frame of the log after a token."""

    def high_watermark(self) -> tuple[int, int, int]:
        """(token, t, i) of the last change; (-1, 0, 0) without any."""

    def oldest_available(self) -> tuple[int, int, int] | None:
        """(token, t, i) of the first change that the log still holds."""


class ParquetChangeSource:
    """A collection and a change log kept as Parquet folders.

    Token filters reach the scan, so files and row groups before the start are
    skipped by their statistics, and the log's ends are read from footers. A
    start takes all files that wait as one batch, unless ``files_per_trigger``
    or ``bytes_per_trigger`` is set.
    """

    def __init__(self, spark: SparkSession, collection: str, log: str, key: str = "_id", files_per_trigger: int | None = None, bytes_per_trigger: str | None = None):
        self.spark, self.collection, self.log, self.key = spark, collection, log, key
        self.files_per_trigger, self.bytes_per_trigger = files_per_trigger, bytes_per_trigger

    def check(self) -> None:
        missing = set(LOG.names) - set(self.spark.read.parquet(self.log).columns)
        if missing:
            raise ValueError(f"the change log has no {', '.join(sorted(missing))}")
        if self.key not in self.spark.read.parquet(self.collection).columns:
            raise ValueError(f"the collection has no {self.key}")

    def snapshot(self) -> DataFrame:
        return self.spark.read.parquet(self.collection)

    def _limited(self) -> DataStreamReader:
        reader = self.spark.readStream
        if self.files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.files_per_trigger)
        if self.bytes_per_trigger:
            reader = reader.option("maxBytesPerTrigger", self.bytes_per_trigger)
        return reader

    def changes(self, after: int | None) -> DataFrame:
        rows = self._limited().schema(LOG).parquet(self.log)
        return rows if after is None else rows.filter(F.col("token") > after)

    def high_watermark(self) -> tuple[int, int, int]:
        return self._end(F.max) or (-1, 0, 0)

    def oldest_available(self) -> tuple[int, int, int] | None:
        return self._end(F.min)

    def _end(self, which: Callable[[str], Column]) -> tuple[int, int, int] | None:
        """The row of the least or greatest token: the token from the files' footers, its time from the row group that holds it."""
        token = footer_end(self.spark, self.log, which)
        if token is None:
            return None
        row = self.spark.read.schema(LOG).parquet(self.log).filter(F.col("token") == token).select("t", "i").orderBy(F.desc("t"), F.desc("i")).first()
        return token, row["t"], row["i"]


def footer_end(spark: SparkSession, log: str, which: Callable[[str], Column]) -> int | None:
    """Least or greatest token of a Parquet log, from statistics alone."""
    settings = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}
    # in a session of its own, so that others keep their settings
    own = spark.newSession()
    for k, v in settings.items():
        own.conf.set(k, v)
    return own.read.schema(LOG).parquet(log).agg(which("token")).first()[0]


class JsonChangeSource(ParquetChangeSource):
    """As ParquetChangeSource, with the log as text files of one JSON change event a line.

    Lines that can't be decoded are written to ``dead_letters``, if named, and
    left out of the feed. The log's ends are found by a scan, as text has no
    statistics.
    """

    def __init__(self, spark: SparkSession, collection: str, log: str, key: str = "_id", dead_letters: str | None = None, **limits: Any):
        super().__init__(spark, collection, log, key, **limits)
        self.dead_letters = dead_letters

    def check(self) -> None:
        self.spark.read.text(self.log)
        if self.key not in self.spark.read.parquet(self.collection).columns:
            raise ValueError(f"the collection has no {self.key}")

    def changes(self, after: int | None) -> DataFrame:
        rows = decode(self._limited().text(self.log))[0]
        return rows if after is None else rows.filter(F.col("token") > after)

    def corrupt(self) -> DataFrame:
        return decode(self._limited().text(self.log))[1]

    def _end(self, which: Callable[[str], Column]) -> tuple[int, int, int] | None:
        row = decode(self.spark.read.text(self.log))[0].agg(which(F.struct("token", "t", "i")).alias("end")).first()["end"]
        return tuple(row) if row else None
