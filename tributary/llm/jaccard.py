"""Sets of five-word shingles, their rare first parts, and the exact comparison of whole sets.

All shingles have one order, rare ones first. Two sets with a similarity of
0.8 share a shingle among the first fifth of each, so they meet in a group per
such shingle. The order is guessed from a sample, which decides how many
candidates there are, but never which links are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import fresh_task, join_small, materialise, shuffle_partitions, slices, small_batches, text_bytes
from tributary.llm.components import forest

WORDS = 5
#: Expected number of documents whose shingles tell which are common.
SAMPLE = 1 << 12
#: Common shingles that all tasks know.
COMMON = 1 << 18
#: Documents of the sample that make a shingle common enough to have a large group.
HOT = 4
#: Texts that are compared with one copy of another text; beyond that it is sent again.
SHARED = 1 << 10
#: Shingles of the sets that are compared in one cell; a set counts with some more, so that a cell has at most 4,096.
CELL = 1 << 20
LEAST_WEIGHT = 1 << 8
#: Pairs of shingles that are added up at once.
ADDED = 1 << 20

_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's five-word shingles, A-Z lower-cased; a shorter text is one shingle, none without words."""
    made, carry, got = [], [], []
    for part in slices(text.lower()):
        got = carry + part.split()
        if len(got) >= WORDS:
            made.append(_hashes(got, WORDS))
        carry = got[len(got) - WORDS + 1 :] if len(got) >= WORDS else got
    if not made and carry:
        made.append(_hashes(carry, len(carry)))
    return np.unique(np.concatenate(made)) if made else np.zeros(0, np.uint64)


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    each, n = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), len(words) - size + 1
    h = sum(each[i : i + n] * _PLACES[i] for i in range(size))
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(29)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets, as sorted hashes, have a Jaccard similarity of 0.8 or more."""
    if not len(a) or not len(b):
        return len(a) == len(b)
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 9 * both >= 4 * (len(a) + len(b))


def common_shingles(texts: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingles on several documents of a sample of rows (at, text), ascending, and on how many."""
    share = min(1.0, sample / max(1, texts.count()))
    drawn = texts.filter(F.pmod(F.xxhash64("at"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        for b in batches:
            for t in text_bytes(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t).view(np.int64))], names=["token"])

    counts = drawn.mapInArrow(run, "token long").groupBy("token").count().filter("count > 1").orderBy(F.desc("count"), "token").limit(COMMON).toArrow()
    tokens = counts.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.minimum(counts.column("count").to_numpy()[order], 1 << 14).astype(np.int16)


def prefix(tokens: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """The first shingles of a set in the common order, more than the fifth that a similar set may lack, and how many of them aren't hot."""
    known, seen = common
    weight = np.zeros(len(tokens), np.int16)
    if len(known):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        weight = np.where(known[at] == tokens, seen[at], 0).astype(np.int16)
    first = np.argsort(weight, kind="stable")[: len(tokens) // 5 + 1]
    return tokens[first], int((weight[first] < HOT).sum())


def verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (x, y) whose whole shingle sets, of rows (at, text), have a similarity of 0.8 or more.

    A text y is sent once to all its x, or once for each ``SHARED`` of them,
    where its set is held while theirs pass by.
    """
    spark = texts.sparkSession
    small_batches(spark)
    pairs = materialise(pairs.select("x", "y"), "pairs")
    many = pairs.groupBy("y").count().filter(F.col("count") > SHARED).select("y", F.ceil(F.col("count") / SHARED).cast("int").alias("of"))
    salt = F.pmod(F.xxhash64("x"), F.coalesce("of", F.lit(1))).cast("int").alias("salt")
    dealt = materialise(join_small(pairs, materialise(many, "many"), "y", "left").select("y", salt, F.col("x").alias("at")), "dealt")
    centres = materialise(dealt.select("y", "salt").distinct(), "centres")
    side = lambda of, x: join_small(texts.select("at", "text"), of, "at").select("y", "salt", x.alias("x"), "text")
    both = side(centres.withColumn("at", F.col("y")), F.lit(None).cast("long")).unionByName(side(dealt, F.col("at")))
    both = both.repartition(shuffle_partitions(spark), "y", "salt").sortWithinPartitions("y", "salt", F.col("x").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        centre = np.zeros(0, np.uint64)
        for b in batches:
            found: tuple[list, list] = ([], [])
            for y, x, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_bytes(b.column(2)), strict=True):
                if x is None:
                    centre = shingles(text)
                elif similar(shingles(text), centre):
                    found[0].append(x)
                    found[1].append(y)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["x", "y"])

    return both.select("y", "x", "text").mapInArrow(compare, "x long, y long")


def overlaps(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """How many shingles each of ``rows`` has in common with each set: shingles of many sets by matrix products, others one by one."""
    k, sizes = len(sets), np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(k), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    start = np.flatnonzero(new)
    length = np.diff(np.r_[start, len(flat)])
    which = np.full(k, -1)
    which[rows] = np.arange(len(rows))
    out = np.zeros((len(rows), k), np.float32)
    each = np.repeat(length, length)
    many = length >= max(32, k // 16)
    column = np.cumsum(many) - 1
    dense = np.repeat(many, length)
    at, who = np.repeat(column, length)[dense], owner[dense]
    step = max(1, ADDED // max(1, k))
    for i in range(0, int(many.sum()), step):
        a, b = np.searchsorted(at, [i, i + step])
        block = np.zeros((k, step), np.float32)
        block[who[a:b], at[a:b] - i] = 1
        out += block[rows] @ block.T
    some = np.flatnonzero(~dense & (each > 1) & (which[owner] >= 0))
    cuts = np.r_[np.flatnonzero(np.diff(np.cumsum(each[some]) // ADDED, prepend=0)), len(some)] if len(some) else []
    begin, first = 0, np.repeat(start, length)
    for end in cuts:
        part = some[begin:end]
        begin = end
        if len(part):
            n = each[part]
            members = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[part], n)
            pairs = np.repeat(which[owner[part]], n) * k + owner[members]
            cell, times = np.unique(pairs, return_counts=True)
            out.ravel()[cell] += times
    return out


def similar_roots(sets: list[np.ndarray], root: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (a, b) of all sets of different roots (and sides, but for -1) that are similar."""
    n = np.array([len(s) for s in sets], np.float64)
    names, label = np.unique(root, return_inverse=True)
    # each pair has a member outside the largest root
    rows = np.flatnonzero(label != np.argmax(np.bincount(label)))
    step = max(1, ADDED // len(sets))
    for i in range(0, len(rows), step):
        some = rows[i : i + step]
        found = 9 * overlaps(sets, some).astype(np.float64) >= 4 * (n[some, None] + n)
        found &= (root[some, None] != root) & ((side[some, None] != side) | (side < 0))
        a, b = np.nonzero(found)
        yield some[a], b


def compare_cells(texts: DataFrame, cells: DataFrame) -> DataFrame:
    """Spanning links (x, y) of the similar sets in cells (grp, side, root, at) of rows (at, text); links within a root are left out."""
    spark = texts.sparkSession
    small_batches(spark)
    cells = materialise(cells, "cells")
    dealt = join_small(texts.select("at", "text"), cells, "at").select("grp", "side", "root", "at", "text")

    def solve(at: list, root: list, side: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        names, label = np.unique(np.array(root), return_inverse=True)

        def links() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            yield from ((label[a], label[b]) for a, b in similar_roots(sets, label, np.array(side)))

        least = forest(len(names), links())
        moved = np.flatnonzero(least != np.arange(len(names)))
        return pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[least[moved]])], names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        now, held = None, ([], [], [], [])
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(4)), text_bytes(b.column(4)), strict=True)
            for grp, side, root, at, text in rows:
                if grp != now and held[0]:
                    yield solve(*held)
                    held = ([], [], [], [])
                now = grp
                for kept, value in zip(held, (at, root, side, shingles(text)), strict=True):
                    kept.append(value)
        if held[0]:
            yield solve(*held)

    return dealt.repartition(shuffle_partitions(spark), "grp").sortWithinPartitions("grp").mapInArrow(run, "x long, y long").distinct()
