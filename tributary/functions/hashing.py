"""Routing documents to logical partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def portable_hash(doc_id: Column) -> Column:
    """60 bits of the md5 of the id's text: never negative, and the same in any engine. A null id hashes as ''."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def partition_of(doc_id: Column, total: int) -> Column:
    """Logical partition in [0, total)."""
    return (portable_hash(doc_id) % total).cast("int")
