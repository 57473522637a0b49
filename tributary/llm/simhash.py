"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints that differ in few bits agree on one of a few blocks of bits, so
each is routed to one group per block. A group is sorted by Gray rank, which
puts fingerprints with long shared patterns side by side, and a tree over the
sorted run factors the bits that all members of a node share into that node.
A search goes down with the differences added up on the shared bits so far,
and drops a whole node once they exceed the limit, or once all its members
are known to belong with the searched one.

For near copies of a word-shingle similarity the groups are other ones: those
of the rare shingles that two similar sets must share, since no block of bits
is short enough. The index then finds which members of a group are near, and
an exact comparison of the whole sets decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm import jaccard
from tributary.llm.common import fresh_task, join_small, materialise, shuffle_partitions, slices, small_batches, text_bytes
from tributary.llm.components import components, forest

FAN = 16
#: Pairs of fingerprint and node that are held at once.
PAIRS = 1 << 19
#: Larger groups are dealt out as pairs of fragments of about this size.
FRAGMENT = 1 << 14
#: Rows of whole groups that are indexed at once.
ROWS = 1 << 17
#: Longs in the fingerprint of a shingle set.
SET_PARTS = 4
#: Bits that fingerprints of similar sets differ in at most. At a similarity of 0.8 the mean is 39 of 256 bits and the
#: deviation 6 (48 and 6 for sets of four and five shingles, the worst), so more than 80 come once in ten million pairs or less.
SET_MOST = 80


def fingerprint(text: bytes, words: int = 4, seed: int = 42, parts: int = 1) -> np.ndarray:
    """SimHash of all word shingles (repeats included) of a text, A-Z lower-cased, in ``parts`` 64-bit parts; 0 without words.

    The first part takes XXH64 of each shingle, further parts are mixed from it.
    """
    h, counts, n, carry = xxhash.xxh64_intdigest, np.zeros(64 * parts, np.int64), 0, []
    for part in slices(text.lower()):
        got = carry + part.split()
        if len(got) >= words:
            joined = b" ".join(got)
            sizes = np.fromiter(map(len, got), np.int64, len(got)) + 1
            ends = np.cumsum(sizes) - 1
            starts = ends - sizes + 1
            hashes = [h(joined[a:b], seed) for a, b in zip(starts[: len(got) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]
            n += len(hashes)
            for i in range(0, len(hashes), 1 << 14):
                counts += _bits(hashes[i : i + (1 << 14)], parts)
        carry = got[len(got) - words + 1 :] if len(got) >= words else got
    if not n and carry:
        n, counts = 1, _bits([h(b" ".join(carry), seed)], parts)
    return np.packbits(counts * 2 > n, bitorder="little").view("<u8") if n else np.zeros(parts, np.uint64)


def _bits(hashes: list[int], parts: int) -> np.ndarray:
    """How many hashes have each bit set."""
    h = np.array(hashes, "<u8")
    mixed = [h]
    for i in range(1, parts):
        x = (h ^ np.uint64(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
        mixed.append(x ^ x >> np.uint64(29))
    raw = np.stack(mixed, axis=1).view(np.uint8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16).astype(np.int64)


def _to_arrow(codes: np.ndarray) -> pa.Array:
    """(n, parts) codes as longs, or as bytes if they have several parts."""
    if codes.shape[1] == 1:
        return pa.array(codes[:, 0].view(np.int64))
    return pa.array([c.tobytes() for c in codes], pa.binary())


def _from_arrow(column: pa.Array, parts: int) -> np.ndarray:
    if parts == 1:
        return column.to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, 1)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, parts)


def _kind(parts: int) -> str:
    return "long" if parts == 1 else "binary"


def fingerprints(docs: DataFrame, words: int = 4, parts: int = 1) -> DataFrame:
    """Append ``code``, the fingerprint of each whole text (null counts as empty), to rows with a text column; the text is dropped."""
    small_batches(docs.sparkSession)
    others = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        for b in batches:
            codes = np.array([fingerprint(t, words, parts=parts) for t in text_bytes(b.column(len(others)))], np.uint64).reshape(-1, parts)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(others)], _to_arrow(codes)], names=[*(f.name for f in others), "code"])

    rows = docs.select(*[f.name for f in others], "text")
    return rows.mapInArrow(run, T.StructType([*others, *T.StructType.fromDDL(f"code {_kind(parts)}").fields]))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code in reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges, which range each member is of, and the members."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)


class GrayIndex:
    """Trees over codes (n, parts) sorted by (group, Gray rank); ``starts`` are the groups' first places.

    ``tags`` are labels of the codes: no link is sought between codes with an
    equal label, so a node whose members all have the searched one is dropped.
    Negative labels are equal to none.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray, tags: tuple[np.ndarray, ...] = ()):
        self.codes, self.n, self.tags = codes, len(codes), tags
        self.labels = [tags]
        edges = np.r_[starts, self.n].astype(np.int64)
        self.group_starts = edges[:-1]
        one, every = codes, codes
        last = np.arange(self.n)
        # from the leaves up: pattern, mask, first child, children, last leaf
        self.levels = [(codes, np.full_like(codes, ~np.uint64(0)), None, None, last)]
        while True:
            sizes = np.diff(edges)
            per = -(-sizes // FAN)
            owner, first = _spread(np.zeros(len(per), np.int64), per)
            first = edges[:-1][owner] + first * FAN
            ends = np.minimum(first + FAN, edges[1:][owner])
            every, one = np.bitwise_and.reduceat(every, first, axis=0), np.bitwise_or.reduceat(one, first, axis=0)
            self.labels.append(tuple(np.where((low := np.minimum.reduceat(t, first)) == np.maximum.reduceat(t, first), low, -1) for t in self.labels[-1]))
            mask = ~(every ^ one)
            last = last[ends - 1]
            self.levels.append((every & mask, mask, first, ends - first, last))
            edges = np.r_[0, np.cumsum(per)]
            if per.max() <= FAN:
                break
        self.tops = edges
        # a child compares only the bits that its parent hasn't compared
        self.fresh = []
        for low, high in zip(self.levels, self.levels[1:], strict=False):
            self.fresh.append(low[1] & ~np.repeat(high[1], high[3], axis=0))
        self.fresh.append(self.levels[-1][1])

    def links(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (a, b), a < b, of all pairs within a group that differ in at most ``most`` bits, in blocks."""
        group_of = np.repeat(np.arange(len(self.group_starts)), np.diff(np.r_[self.group_starts, self.n]))
        tops = np.diff(self.tops)[group_of]
        held = max(FAN, PAIRS // self.codes.shape[1])
        block = np.maximum.accumulate(np.cumsum(tops) // held)
        cuts = np.r_[0, np.flatnonzero(np.diff(block)) + 1, self.n]
        top = len(self.levels) - 1

        def down(level: int, who: np.ndarray, nodes: np.ndarray, far: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """The leaves below pairs of code and node; one block of pairs a level is held."""
            if level == 0:
                if len(who):
                    yield who, nodes
                return
            first, count = self.levels[level][2], self.levels[level][3]
            for i in range(0, len(who), held // FAN):
                some = slice(i, i + held // FAN)
                owner, child = _spread(first[nodes[some]], count[nodes[some]])
                yield from down(level - 1, *self._keep(level - 1, who[some][owner], child, far[some][owner], most))

        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            owner, nodes = _spread(self.tops[group_of[a:b]], tops[a:b])
            who = owner + a
            yield from down(top, *self._keep(top, who, nodes, np.zeros(len(who), np.int16), most))

    def _keep(self, level: int, who: np.ndarray, nodes: np.ndarray, far: np.ndarray, most: int):
        pattern, _, _, _, last = self.levels[level]
        later = last[nodes] > who
        for mine, label in zip(self.tags, self.labels[level], strict=True):
            later &= (label[nodes] != mine[who]) | (label[nodes] < 0)
        who, nodes, far = who[later], nodes[later], far[later]
        far = far + np.bitwise_count((self.codes[who] ^ pattern[nodes]) & self.fresh[level][nodes]).sum(axis=1, dtype=np.int16)
        near = far <= most
        return who[near], nodes[near], far[near]


def block_routes(codes: np.ndarray, most: int, agree: int = 1) -> np.ndarray:
    """Groups of 64-bit codes, one for each choice of ``agree`` among most + agree blocks of bits: codes within ``most`` differences meet in one."""
    n = most + agree
    edges = [round(64 * i / n) for i in range(n + 1)]
    cut = [codes[:, 0] >> np.uint64(a) & np.uint64((1 << (b - a)) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    routes = []
    for number, chosen in enumerate(combinations(range(n), agree)):
        key = np.zeros(len(codes), np.uint64)
        for i in chosen:
            key = key << np.uint64(edges[i + 1] - edges[i]) | cut[i]
        routes.append(key.astype(np.int64) | number << 48)
    return np.stack(routes, axis=1)


def blocks_that_agree(n: int, most: int, fragment: int = FRAGMENT) -> int:
    """The least number of blocks of bits that makes groups of n spread codes no larger than ``fragment``; any number loses no link."""
    agree = 1
    while agree < 3 and n / 2 ** (64 * agree / (most + agree)) > fragment:
        agree += 1
    return agree


def _router(route: Callable[[np.ndarray], np.ndarray], parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = b.column(0)[i : i + 4096]
                to = route(_from_arrow(part, parts))
                each = np.repeat(np.arange(len(part)), to.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(to.ravel()), part.take(pa.array(each))], names=["route", "code"])

    return run


def _index_groups(most: int, parts: int):
    """Rows (grp, code), whole groups in a row, to spanning links (x, y) of each group."""

    def solve(keys: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((gray_rank(codes[:, 0]), keys))
        keys, codes = keys[order], codes[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        root = forest(len(codes), GrayIndex(codes, starts).links(most))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([_to_arrow(codes[moved]), _to_arrow(codes[root[moved]])], names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        keys, codes, held = [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            keys.append(b.column(0).to_numpy())
            codes.append(_from_arrow(b.column(1), parts))
            held += b.num_rows
            if held >= ROWS:
                k, c = np.concatenate(keys), np.concatenate(codes)
                cut = int(np.argmax(k == k[-1]))  # the last group may go on
                if cut:
                    yield solve(k[:cut], c[:cut])
                keys, codes, held = [k[cut:]], [c[cut:]], len(k) - cut
        if held:
            yield solve(np.concatenate(keys), np.concatenate(codes))

    return run


def near_links(codes: DataFrame, most: int, parts: int = 1, fragment: int = FRAGMENT, agree: int | None = None) -> DataFrame:
    """Spanning links (x, y) of distinct codes (column code) that differ in ``most`` or fewer bits and meet in a group.

    Groups are of codes that agree on ``agree`` blocks of bits (more, the more
    codes there are), in which every such pair meets. A group beyond
    ``fragment`` codes is dealt out as all pairs of its fragments, so that no
    task holds it whole and no pair is lost.
    """
    agree = agree or blocks_that_agree(codes.count(), most)
    routed = codes.select("code").mapInArrow(_router(lambda c: block_routes(c, most, agree), parts), f"route long, code {_kind(parts)}")
    # few: a group has more than ``fragment`` members
    large = routed.groupBy("route").count().filter(F.col("count") > fragment).select("route", F.ceil(F.col("count") / fragment).cast("int").alias("of"))
    dealt = join_small(routed, materialise(large, "large"), "route", "left")
    mine = F.pmod(F.xxhash64("code"), F.col("of")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("of") - 1), lambda i: F.least(i, mine) * F.col("of") + F.greatest(i, mine))
    dealt = dealt.select("route", "code", F.explode(F.when(F.col("of").isNull(), F.array(F.lit(0))).otherwise(others)).alias("pair"))
    grouped = dealt.select(F.when(F.col("pair") == 0, F.col("route")).otherwise(F.xxhash64("route", "pair")).alias("grp"), "code")
    n = shuffle_partitions(codes.sparkSession)
    return grouped.repartition(n, "grp").sortWithinPartitions("grp").mapInArrow(_index_groups(most, parts), f"x {_kind(parts)}, y {_kind(parts)}")


def group_codes(marked: DataFrame, least: Column, **search) -> DataFrame:
    """Distinct codes of materialised rows with a code, each with the least value of ``least`` over all codes it reaches: code, first."""
    distinct = materialise(marked.groupBy("code").agg(F.min(least).alias("least")), "codes")
    roots = components(near_links(distinct, **search)).select(F.col("x").alias("code"), F.col("y").alias("root"))
    placed = materialise(distinct.join(roots, "code", "left").withColumn("root", F.coalesce("root", "code")), "placed")
    # written first, so that the join reads plain shuffles and the rows of a large group can be split
    named = materialise(placed.groupBy("root").agg(F.min("least").alias("first")), "named")
    return placed.select("code", "root").join(named, "root").select("code", "first")


def near_duplicates(docs: DataFrame, words: int = 4, most: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document (doc_id, text).

    64-bit fingerprints link at ``most`` or fewer differing bits, and no link
    is lost. Documents without words have fingerprint 0 and are linked like
    others. component_id is the least doc_id reachable; null doc_ids are
    documents but not least ids (null if a component has no other). Equal rows
    are returned each; an empty table gives no rows.
    """
    marked = materialise(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), words), "fingerprints")
    of_code = group_codes(marked, F.col("doc_id"), most=most)
    return marked.join(of_code, "code").select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))


# --- near copies by shingle similarity -----------------------------------------

_MET = "token long, at long, n int, place int"
_CODES = [f"code{i}" for i in range(SET_PARTS)]


def set_fingerprint(hashes: np.ndarray, parts: int = SET_PARTS) -> np.ndarray:
    """SimHash of a set of 64-bit hashes; 0 for the empty set."""
    counts = np.zeros(64 * parts, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        counts += _bits(hashes[i : i + (1 << 14)], parts)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")


def distinct_sets(texts: DataFrame) -> DataFrame:
    """One row of each shingle set of rows (doc_id, at, text), that of least (doc_id, at): doc_id, at, n, calm, prefix, code0 to code3.

    ``prefix`` are the set's first shingles, of which the first ``calm`` aren't hot.
    """
    small_batches(texts.sparkSession)
    shared = texts.sparkSession.sparkContext.broadcast(jaccard.common_shingles(texts.select("at", "text")))
    names = ["n", "calm", "prefix", *_CODES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        for b in batches:
            sets = [jaccard.shingles(t) for t in text_bytes(b.column(2))]
            digest = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            heads = [jaccard.prefix(s, shared.value) for s in sets]
            codes = np.array([set_fingerprint(s) for s in sets], np.uint64).reshape(-1, SET_PARTS).view(np.int64)
            columns = [pa.array([len(s) for s in sets], pa.int32()), pa.array([c for _, c in heads], pa.int32()), pa.array([h.tobytes() for h, _ in heads], pa.binary())]
            yield pa.RecordBatch.from_arrays([digest, b.column(0), b.column(1), *columns, *(pa.array(codes[:, i]) for i in range(SET_PARTS))], names=["digest", "doc_id", "at", *names])

    kind = texts.schema["doc_id"].dataType.simpleString()
    made = texts.select("doc_id", "at", "text").mapInArrow(run, f"digest binary, doc_id {kind}, at long, n int, calm int, prefix binary, " + ", ".join(f"{c} long" for c in _CODES))
    return made.groupBy("digest").agg(F.min(F.struct("doc_id", "at", *names)).alias("least")).select("least.*")


def _heads(hot: bool):
    """Rows (at, n, calm, prefix) to one row per hot (or other) shingle of the prefix and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                rows = b.slice(i, 256)
                heads = [np.frombuffer(x, np.int64) for x in rows.column(3).to_pylist()]
                calm = rows.column(2).to_numpy()
                lows = calm if hot else np.zeros(len(heads), np.int64)
                parts = [h[c:] if hot else h[:c] for h, c in zip(heads, calm.tolist(), strict=True)]
                sizes = np.fromiter(map(len, parts), np.int64, len(parts))
                each, place = _spread(lows, sizes)
                at, n = (rows.column(c).to_numpy()[each] for c in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts)), pa.array(at), pa.array(n), pa.array(place.astype(np.int32))], names=["token", "at", "n", "place"])

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by their first column, those that share it with another row."""
    fresh_task()
    held, before, names = None, False, []
    for b in batches:
        if not b.num_rows:
            continue
        names = b.schema.names
        now = [c.to_numpy() for c in b.columns]
        columns = now if held is None else [np.r_[h, c] for h, c in zip(held, now, strict=True)]
        same = columns[0][1:] == columns[0][:-1]
        keep = np.r_[before, same[:-1]] | same if len(same) else np.zeros(0, bool)
        yield pa.RecordBatch.from_arrays([pa.array(c[:-1][keep]) for c in columns], names=names)
        held, before = [c[-1:] for c in columns], bool(same[-1]) if len(same) else before
    if held is not None and before:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=names)


def meetings(sets: DataFrame) -> DataFrame:
    """(token, at, n, place) of the prefixes' shingles that other sets may have as well.

    Hot shingles are known to be shared and aren't shuffled to find that out,
    so no task holds the rows of a shingle that many documents have.
    """
    heads = sets.filter("n > 0").select("at", "n", "calm", "prefix")
    calm = heads.mapInArrow(_heads(False), _MET).repartition(shuffle_partitions(sets.sparkSession), "token").sortWithinPartitions("token").mapInArrow(_met, _MET)
    return materialise(calm.unionByName(heads.filter("calm * 8 < octet_length(prefix)").mapInArrow(_heads(True), _MET)), "met")


def _may_be_similar(a: np.ndarray, b: np.ndarray, at: np.ndarray, n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of rows of one group, whether sizes and places allow a similarity of 0.8 if this is the first shingle that both have."""
    most = np.minimum(n[a] - place[a], n[b] - place[b])
    return (at[a] != at[b]) & (5 * np.minimum(n[a], n[b]) >= 4 * np.maximum(n[a], n[b])) & (9 * most >= 4 * (n[a] + n[b]))


def _group_pairs(neighbours: bool):
    """Rows (grp, at, n, place, side, root, code0 to code3), whole groups in a row, to pairs (x, y), x > y, that may be similar.

    With ``neighbours``, each row gives its neighbour in Gray order and its
    group's least row. Else the pairs are of roots: the index finds all pairs
    of different roots and sides, and a spanning part of them goes on.
    """

    def solve(grp, at, n, place, side, root, *codes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        codes = np.stack(codes, axis=1).view(np.uint64)
        order = np.lexsort((at, gray_rank(codes[:, 0]), grp))
        grp, at, n, place, side, root, codes = (c[order] for c in (grp, at, n.astype(np.int64), place.astype(np.int64), side, root, codes))
        starts = np.flatnonzero(np.r_[True, grp[1:] != grp[:-1]])
        if not neighbours:
            names, node = np.unique(root, return_inverse=True)

            def links() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for a, b in GrayIndex(codes, starts, (root, side)).links(SET_MOST):
                    fit = _may_be_similar(a, b, at, n, place)
                    yield node[a[fit]], node[b[fit]]

            least = forest(len(names), links())
            moved = np.flatnonzero(least != np.arange(len(names)))
            yield names[moved], names[least[moved]]
            return
        group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(grp)]))
        least = np.lexsort((at, grp))[starts][group]
        before = np.maximum(np.arange(len(grp)) - 1, starts[group])
        for b in (least, before):
            a = np.flatnonzero(_may_be_similar(np.arange(len(grp)), b, at, n, place))
            b = b[a]
            near = np.bitwise_count(codes[a] ^ codes[b]).sum(axis=1, dtype=np.int16) <= SET_MOST
            yield at[a[near]], at[b[near]]

    def packed(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for x, y in pairs:
            held.append(np.stack([np.maximum(x, y), np.minimum(x, y)], axis=1))
            size += len(x)
            if size >= ROWS:
                yield flat(held)
                held, size = [], 0
        if size:
            yield flat(held)

    def flat(held: list[np.ndarray]) -> pa.RecordBatch:
        x, times = np.unique(np.concatenate(held), axis=0, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(times)], names=["x", "y", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append([c.to_numpy() for c in b.columns])
            size += b.num_rows
            if size >= ROWS:
                columns = [np.concatenate(c) for c in zip(*held, strict=True)]
                cut = int(np.argmax(columns[0] == columns[0][-1]))  # the last group may go on
                if cut:
                    yield from packed(solve(*(c[:cut] for c in columns)))
                held, size = [[c[cut:] for c in columns]], len(columns[0]) - cut
        if held:
            yield from packed(solve(*(np.concatenate(c) for c in zip(*held, strict=True))))

    return run


def _grouped(rows: DataFrame, sets: DataFrame, neighbours: bool) -> DataFrame:
    """Rows (grp, at, n, place, side, root) with their codes, to distinct pairs (x, y) and how many groups each has."""
    coded = rows.join(sets.select("at", *_CODES), "at").select("grp", "at", "n", "place", "side", "root", *_CODES)
    dealt = coded.repartition(shuffle_partitions(rows.sparkSession), "grp").sortWithinPartitions("grp")
    return dealt.mapInArrow(_group_pairs(neighbours), "x long, y long, times long").groupBy("x", "y").agg(F.sum("times").alias("times"))


def first_pairs(met: DataFrame, sets: DataFrame, fragment: int) -> DataFrame:
    """For each set the one it meets most often, among its neighbours in Gray order and the least of its groups.

    Groups beyond ``fragment`` rows are dealt out; what parts miss of each other is left to candidate_roots().
    """
    large = met.groupBy("token").count().filter(F.col("count") > fragment).select("token", F.ceil(F.col("count") / fragment).cast("int").alias("of"))
    dealt = join_small(met, materialise(large, "large"), "token", "left")
    part = F.pmod(F.xxhash64("at"), F.col("of"))
    none = F.lit(-1).cast("long")
    rows = dealt.select(F.when(F.col("of").isNull(), F.col("token")).otherwise(F.xxhash64("token", part)).alias("grp"), "at", "n", "place", none.alias("side"), none.alias("root"))
    pairs = _grouped(rows, sets, True)
    return pairs.groupBy("x").agg(F.max(F.struct("times", (-F.col("y")).alias("y"))).alias("best")).select("x", (-F.col("best.y")).alias("y"))


def deal(rows: DataFrame, key: str, weight: str, most: int) -> DataFrame:
    """Rows (key, root, at, weight, ...) to cells in which all rows of a key meet but those of one root: adds grp and side.

    Keys of one root are left out. A key beyond ``most`` weight is cut into
    fragments: a root beyond ``most`` gets its own, other rows share some. Each
    two fragments that aren't of one root make a cell with two sides; a
    fragment by itself has side -1.
    """
    sizes = rows.groupBy(key, "root").agg(F.sum(weight).alias("size")).groupBy(key).agg(
        F.count(F.lit(1)).alias("roots"), F.sum("size").alias("size"), F.sum(F.when(F.col("size") <= most, F.col("size")).otherwise(0)).alias("light"),
        F.collect_list(F.when(F.col("size") > most, F.struct("root", F.ceil(F.col("size") / most).cast("int").alias("of")))).alias("heavy"),
    )
    shared = materialise(sizes.filter("roots > 1"), "shared")
    others = [c for c in rows.columns if c not in (key, "root")]
    small = join_small(rows, shared.filter(F.col("size") <= most).select(key), key, "left_semi")
    small = small.select(F.col(key).alias("grp"), F.lit(-1).cast("long").alias("side"), "root", *others)
    light = F.ceil(F.col("light") / most).cast("int")
    # the root of each fragment, -1 for the shared ones, which come first
    labels = F.flatten(F.concat(F.array(F.array_repeat(F.lit(-1).cast("long"), light)), F.transform("heavy", lambda h: F.array_repeat(h["root"], h["of"]))))
    large = materialise(shared.filter(F.col("size") > most).select(key, light.alias("light_of"), labels.alias("labels")), "large")
    dealt = join_small(rows, large, key)
    first = F.array_position("labels", F.col("root")).cast("int")  # from 1; 0 for rows of shared fragments
    of = F.when(first == 0, F.col("light_of")).otherwise(F.size(F.filter("labels", lambda x: x == F.col("root"))))
    dealt = dealt.withColumn("own", (F.greatest(first - 1, F.lit(0)) + F.pmod(F.xxhash64("at"), of)).cast("int"))
    meets = F.filter(F.sequence(F.lit(0), F.size("labels") - 1), lambda i: (F.get("labels", i) == -1) | (F.get("labels", i) != F.get("labels", F.col("own"))))
    dealt = dealt.select(key, "root", "own", *others, F.explode(meets).alias("other"))
    pair = F.struct(F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).cast("long")
    return small.unionByName(dealt.select(F.xxhash64(key, pair).alias("grp"), side.alias("side"), "root", *others))


def candidate_roots(met: DataFrame, sets: DataFrame, roots: DataFrame, fragment: int) -> DataFrame:
    """Pairs of roots (x, y) that connect all roots with sets that may be similar; ``roots`` (at, root) are those of sets already joined."""
    rooted = join_small(met, roots, "at", "left").withColumn("root", F.coalesce("root", "at")).withColumn("one", F.lit(1).cast("long"))
    return _grouped(deal(materialise(rooted, "rooted"), "token", "one", fragment).drop("one"), sets, False).select("x", "y")


def similar_links(texts: DataFrame, sets: DataFrame, fragment: int = FRAGMENT) -> DataFrame:
    """(x, y) for each of the distinct sets that links to another, y the least ``at`` that x reaches.

    First each set is compared with its likeliest partner. Roots that may still
    have similar sets are brought together in clusters, whose sets are compared
    whole, all of one root with those of the others.
    """
    met = meetings(sets)
    first = materialise(jaccard.verified(texts, first_pairs(met, sets, fragment)), "first")
    joined = components(first)
    roots = joined.select(F.col("x").alias("at"), F.col("y").alias("root"))
    pairs = materialise(candidate_roots(met, sets, roots, fragment), "pairs")
    if pairs.isEmpty():
        return joined
    linked = components(pairs)
    linked = materialise(linked.unionByName(linked.select(F.col("y").alias("x"), "y").distinct()).select(F.col("x").alias("root"), F.col("y").alias("cluster")), "clusters")
    rooted = sets.select("at", "n").join(roots, "at", "left").withColumn("root", F.coalesce("root", "at")).join(linked, "root")
    weighed = materialise(rooted.select("cluster", "root", "at", (F.col("n") + jaccard.LEAST_WEIGHT).cast("long").alias("weight")), "weighed")
    found = jaccard.compare_cells(texts, deal(weighed, "cluster", "weight", jaccard.CELL).drop("weight"))
    return components(first.unionByName(found))


def distinct_documents(docs: DataFrame, fragment: int = FRAGMENT) -> DataFrame:
    """One document of each group of near copies, the one of least (doc_id, row), all columns kept.

    Two texts are near copies if the Jaccard similarity of their sets of
    five-word shingles is 0.8 or more, and a group is what such links connect;
    none but what ``SET_MOST`` says is missed, and no other link counts. Texts
    without words (null, empty) are one group, and so are equal texts; null
    doc_ids come first; an empty table gives no rows.
    """
    rows = materialise(docs.select(F.struct("*").alias("row")).withColumn("at", F.monotonically_increasing_id()), "documents")
    texts = rows.select(F.col("row.doc_id").alias("doc_id"), "at", F.col("row.text").alias("text"))
    sets = materialise(distinct_sets(texts), "sets")
    roots = similar_links(texts, sets, fragment).select(F.col("x").alias("at"), F.col("y").alias("root"))
    placed = materialise(sets.select("doc_id", "at").join(roots, "at", "left").withColumn("root", F.coalesce("root", "at")), "placed")
    first = placed.groupBy("root").agg(F.min(F.struct("doc_id", "at")).alias("first")).select(F.col("first.at").alias("at"))
    return rows.join(first, "at", "left_semi").select("row.*")
