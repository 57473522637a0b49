"""Exact top-k inner products over integer vectors.

Candidates are cut into blocks by descending length. Against a block of
queries, a block is scored on its first rotated dimensions (the axes of
greatest spread, from the SVD of all vectors); the rest of a product is at
most the product of the residual lengths (Cauchy-Schwarz), so pairs whose
bound is under the query's k-th score are dropped before the next dimensions
are added, and a query is done once even the block's longest vector cannot
reach it. Pairs that are left get exact integer scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import materialise, shuffle_partitions, small_batches, task_id

#: Rows in a block of candidates, and in a block of queries.
CANDIDATES = 16_384
QUERIES = 1_024
#: Longest vectors that give the first floors.
SEED = 4_096
#: Tasks that blocks of candidates are dealt to, at most.
MOST_TASKS = 20_000
#: Candidates scored at once in a block; shares of the dimensions after which pairs are dropped.
STRIP = 1_024
STEPS = (0.25, 0.5)


def quantise(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id, vector (little-endian int64 of floor(scale * x)), norm, dims; rows with null or non-finite parts are left out.

    Vectors with a component whose floor does not fit a long are left out as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            flat, offsets = lists.values, lists.offsets.to_numpy()
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(scale * flat.to_numpy(zero_copy_only=False).astype(np.float64))
            # a null is NaN here; sums by differences of running counts, as lists may be empty or null
            bad = np.r_[0, np.cumsum(~(np.abs(x) < 2.0**63))]
            good = lists.is_valid().to_numpy(zero_copy_only=False) & b.column(0).is_valid().to_numpy(zero_copy_only=False)
            good &= bad[offsets[1:]] == bad[offsets[:-1]]
            raw = np.where(np.abs(x) < 2.0**63, x, 0).astype("<i8")
            at = np.flatnonzero(good)
            pieces = [raw[offsets[i] : offsets[i + 1]] for i in at]
            norms = [float(np.sqrt((v.astype(np.float64) ** 2).sum())) for v in pieces]
            columns = [b.column(0).take(pa.array(at)), pa.array([v.tobytes() for v in pieces], pa.binary()), pa.array(norms, pa.float64()), pa.array(np.diff(offsets)[at].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector", "norm", "dims"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, "vec_id long, vector binary, norm double, dims int")


def _matrix(rows: list[bytes], dims: int) -> np.ndarray:
    """Vectors one below the other, shorter ones filled with zeros."""
    if all(len(r) == 8 * dims for r in rows):
        return np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), dims)
    out = np.zeros((len(rows), dims), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r) // 8] = np.frombuffer(r, "<i8")
    return out


def rotation(quantised: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all vectors, by falling singular value, from the dims x dims Gram matrix summed over tasks."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for b in batches:
            x = _matrix(b.column(0).to_pylist(), dims).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], names=["at", "value"])

    summed = quantised.select("vector").mapInArrow(gram, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    cells = summed.toPandas()
    matrix = np.zeros(dims * dims)
    matrix[cells["at"].to_numpy()] = cells["value"].to_numpy()
    return np.linalg.eigh(matrix.reshape(dims, dims))[1][:, ::-1].copy()


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of matching rows; sums beyond 64 bits stop at its ends."""
    if len(q) and q.shape[1] and float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] >= 2.0**62:
        wide = (q.astype(object) * c.astype(object)).sum(axis=1)
        return np.array([min(max(int(x), -(2**63)), 2**63 - 1) for x in wide], np.int64)
    return (q * c).sum(axis=1)


def search(queries: Block, candidates: Block, k: int):
    """Best k of candidates (by falling norm) for each query, but the query's own row: arrays query place, vec_id, score."""
    q, rq, c, rc, norms, floor = queries.vectors, queries.turned, candidates.vectors, candidates.turned, candidates.norms, queries.floors
    dims = q.shape[1]
    cuts = sorted({max(1, round(dims * s)) for s in STEPS if dims}) + [dims]
    rest_q = [np.sqrt((rq[:, x:] ** 2).sum(axis=1)) for x in cuts]
    rest_c = [np.sqrt((rc[:, x:] ** 2).sum(axis=1)) for x in cuts]
    norm_q = np.sqrt((rq**2).sum(axis=1))
    need = floor.astype(np.float64)
    best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    for i in range(0, len(c), STRIP):
        strip = slice(i, i + STRIP)
        slack = 1e-9 * norm_q * norms[i] + 1e-3
        live = np.flatnonzero(norm_q * norms[i] + slack >= need)
        if not len(live):
            break
        part = rq[live, : cuts[0]] @ rc[strip, : cuts[0]].T
        row, col = np.nonzero(part + np.outer(rest_q[0][live], rest_c[0][strip]) + slack[live, None] >= need[live, None])
        sums = part[row, col]
        for step in range(1, len(cuts)):
            whole = step == 1 and len(row) > part.size // 16  # many are left: a matrix product is cheaper than pairs
            if whole:
                sums, bound = (rq[live] @ rc[strip].T)[row, col], 0.0
            else:
                a, b = cuts[step - 1], cuts[step]
                sums = sums + np.einsum("ij,ij->i", rq[live[row], a:b], rc[i + col, a:b])
                bound = rest_q[step][live[row]] * rest_c[step][i + col]
            keep = sums + bound + slack[live[row]] >= need[live[row]]
            row, col, sums = row[keep], col[keep], sums[keep]
            if whole:
                break
        who = live[row]
        own = queries.rows[who] != candidates.rows[i + col]
        who, col = who[own], i + col[own]
        if not len(who):
            continue
        if len(who) > 8 * k * len(q):  # exact scores only for what can be among the best of this strip
            who, col = _shortlist(who, col, sums[own], norm_q, norms[i], k)
        best = _best(np.r_[best[0], who], np.r_[best[1], candidates.ids[col]], np.r_[best[2], exact_scores(q[who], c[col])], k)
        counts = np.bincount(best[0], minlength=len(q))
        full = np.flatnonzero(counts == k)
        last = np.cumsum(counts) - 1
        need[full] = np.maximum(need[full], best[2][last[full]])
    return best


def _shortlist(who, col, sums, norm_q, longest, k):
    """Drop pairs that k others of the same query exceed by more than rounding."""
    order = np.lexsort((-sums, who))
    w, s = who[order], sums[order]
    start = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
    size = np.diff(np.r_[start, len(w)])
    kth = np.repeat(s[np.minimum(start + k - 1, start + size - 1)], size)
    keep = s >= kth - 2e-9 * norm_q[w] * longest - 2e-3
    return w[keep], col[order][keep]


def _best(who: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int):
    order = np.lexsort((vec, -score, who))
    who, vec, score = who[order], vec[order], score[order]
    start = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
    rank = np.arange(len(who)) - np.repeat(start, np.diff(np.r_[start, len(who)]))
    return who[rank < k], vec[rank < k], score[rank < k]


class Block:
    """Vectors of one block by falling norm, rotated once however often they are searched."""

    def __init__(self, packed: dict, dims: int, turn: np.ndarray):
        self.rows, self.ids = (np.frombuffer(packed[k], "<i8") for k in ("rows", "ids"))
        self.vectors = np.frombuffer(packed["vectors"], f"<i{packed['width']}").astype(np.int64).reshape(len(self.ids), dims)
        self.floors = np.frombuffer(packed["floors"], "<f8")
        self.norms = np.sqrt((self.vectors.astype(np.float64) ** 2).sum(axis=1))
        order = np.argsort(-self.norms, kind="stable")
        self.rows, self.ids, self.vectors, self.floors, self.norms = (x[order] for x in (self.rows, self.ids, self.vectors, self.floors, self.norms))
        self.turned = self.vectors @ turn


_PARTS = ("width", "rows", "ids", "vectors", "floors")
_PACKED = "block long, longest double, need double, width int, rows binary, ids binary, vectors binary, floors binary"


def _pack(rows: DataFrame, size: int, dims: int, order: list, partitions: int) -> DataFrame:
    """Rows (at, vec_id, vector, floor) to one row per block of up to ``size`` neighbours in ``order``, vectors in the least width that holds them.

    ``longest`` is a block's greatest norm, ``need`` the least norm of a candidate that may reach one of its floors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = ([], [], [], []), task_id() << 33

        def block() -> pa.RecordBatch:
            x, floors = _matrix(held[2], dims), np.array(held[3], "<f8")
            most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
            width = next(w for w in (2, 4, 8) if most < 1 << (8 * w - 1) or w == 8)
            norms = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
            # as search() drops queries, with its slack
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(floors <= 1e-3, -1.0, (floors - 2e-3) / (norms * (1 + 2e-9)))
            parts = ([number], [float(norms.max(initial=0))], [float(need.min(initial=np.inf))], [width], *([np.array(v, "<i8").tobytes()] for v in held[:2]), [x.astype(f"<i{width}").tobytes()], [floors.tobytes()])
            kinds = (pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(parts, kinds, strict=True)], names=["block", "longest", "need", *_PARTS])

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                for kept, value in zip(held, row, strict=True):
                    kept.append(value)
                if len(held[0]) == size:
                    yield block()
                    held, number = ([], [], [], []), number + 1
        if held[0]:
            yield block()

    dealt = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("at", "vec_id", "vector", "floor")
    return dealt.mapInArrow(run, _PACKED)


_FOUND = "query_at long, query_id long, vec_id long, score long"


def _answer(queries: Block, candidates: Block, k: int) -> pa.RecordBatch:
    who, vec, score = search(queries, candidates, k)
    return pa.RecordBatch.from_arrays([pa.array(queries.rows[who]), pa.array(queries.ids[who]), pa.array(vec), pa.array(score)], names=["query_at", "query_id", "vec_id", "score"])


def _best_of(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_at").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _score_seed(queries: DataFrame, seed: dict, dims: int, turn: np.ndarray, k: int) -> DataFrame:
    """Each query's best k in the one block of the longest vectors, which every task gets (at most ``SEED`` vectors)."""
    shared = queries.sparkSession.sparkContext.broadcast((seed, turn))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, turn = shared.value
        candidates = Block(packed, dims, turn)
        for b in batches:
            for q in b.to_pylist():
                yield _answer(Block(q, dims, turn), candidates, k)

    return _best_of(queries.select(*_PARTS).mapInArrow(run, _FOUND), k)


def _score(queries: DataFrame, candidates: DataFrame, dims: int, turn: np.ndarray, k: int) -> DataFrame:
    """Each query's best k in each block of candidates that may hold one of them.

    By Cauchy-Schwarz a block whose longest vector is under what a block of
    queries needs can't, so such pairs of blocks are never sent. A block of
    candidates is opened once; the blocks of queries pass by it.
    """
    # one row per ``CANDIDATES`` vectors: a number and a norm
    norms = sorted(((r["longest"], r["block"]) for r in candidates.select("longest", "block").collect()), reverse=True)
    spark = candidates.sparkSession
    shared = spark.sparkContext.broadcast((np.array([-x for x, _ in norms]), turn))
    cell_of = spark.createDataFrame([(b, i) for i, (_, b) in enumerate(norms)], "block long, cell int")
    c = candidates.join(cell_of, "block").select("cell", F.lit(0).alias("kind"), *_PARTS)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        falling = shared.value[0]
        for b in batches:
            for i in range(b.num_rows):
                cells = int(np.searchsorted(falling, -b.column(0)[i].as_py(), side="right"))
                for j in range(0, cells, 64):
                    n = min(64, cells - j)
                    row = [b.column(m).slice(i, 1).take(pa.array(np.zeros(n, np.int64))) for m in range(1, b.num_columns)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(j, j + n, dtype=np.int32)), pa.array(np.ones(n, np.int32)), *row], names=["cell", "kind", *_PARTS])

    packed = "cell int, kind int, width int, rows binary, ids binary, vectors binary, floors binary"
    q = queries.select("need", *_PARTS).mapInArrow(sent, packed)
    both = c.unionByName(q).repartition(min(max(len(norms), 1), MOST_TASKS), "cell").sortWithinPartitions("cell", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, block = shared.value[1], None
        for b in batches:
            for row in b.to_pylist():
                if row["kind"] == 0:
                    block = Block(row, dims, turn)
                else:
                    yield _answer(Block(row, dims, turn), block, k)

    return _best_of(both.mapInArrow(run, _FOUND), k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """Best k other rows by inner product of each query row: query_id, rank (from 1), vec_id, score; ties to the smaller vec_id.

    Reads vec_id and embedding. Rows whose vec_id is null, or whose embedding
    is null or has a null, NaN or infinite part, take no part; shorter vectors
    count as filled with zeros. Every row but a query's own is a candidate:
    rows that share a vec_id, equal or not, each are, and each is a query if
    one is. An empty table gives no rows.

    Queries and candidates meet as blocks of bounded size, after a block of the
    longest vectors has given every query a floor for its k-th score.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = materialise(quantise(vectors).withColumn("at", F.monotonically_increasing_id()), "vectors")
    counts = rows.agg(F.count(F.lit(1)), F.max("dims"), F.count_if(is_query)).first()
    if not counts[0] or not counts[2]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims, n = counts[1], shuffle_partitions(spark)
    turn = rotation(rows, dims)
    longest = [F.desc("norm"), F.col("vec_id"), F.col("at")]
    rows = rows.select("at", "vec_id", "vector", "norm", F.lit(float("-inf")).alias("floor"))
    queries, query_blocks = rows.filter(is_query), -(-counts[2] // QUERIES)
    candidates = materialise(_pack(rows, CANDIDATES, dims, longest, max(n, -(-counts[0] // CANDIDATES))), "candidates")
    seed = _pack(rows.orderBy(*longest).limit(SEED), SEED, dims, longest, 1).first().asDict()
    first = _score_seed(_pack(queries, QUERIES, dims, ["vec_id", "at"], query_blocks), seed, dims, turn, k)
    floors = first.filter(F.col("rank") == k).select(F.col("query_at").alias("at"), F.col("score").cast("double").alias("known"))
    floored = queries.drop("floor").join(floors, "at", "left").withColumn("floor", F.coalesce("known", F.lit(float("-inf"))))
    blocks = materialise(_pack(floored, QUERIES, dims, ["vec_id", "at"], query_blocks), "queries")
    best = _score(blocks, candidates, dims, turn, k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
