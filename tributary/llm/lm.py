"""Language-model scores by prediction by partial matching (PPM), pretrained on a part of the corpus.

The model is a byte-context trie four deep, counted over all training texts.
A byte not seen in the longest context escapes to the next shorter one (an
escape's share is the number of distinct bytes seen there), where the bytes
seen in the longer context are excluded. As the trained trie doesn't change
while scoring, every context's escapes are worked out once.

The trie's contexts are whole bytes at every depth. They grow with the corpus,
so the trie is a distributed table of nodes: texts are read in chunks, and each
chunk is sent the nodes of its own contexts by a shuffle join. No task and no
driver holds the trie.

Beside it stands a unigram base score. Its vocabulary isn't bounded: words
with at least a 2**-20 share of the training tokens (so at most 2**20 of
them) go to every task, and the rest meet their counts in a shuffle join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import groups_of, materialise, slices, small_batches, task_id, text_bytes

END = 256
SYMBOLS = 257
#: Bytes in a deepest context. A node is its depth, then its bytes; a key is a node, then a symbol.
LONG = 4
NODE_BITS = 8 * LONG
SYMBOL_BITS = 9
#: Bytes of text that are sent their contexts together (more only for one longer text).
TEXTS = 16 << 20
#: Bytes of text whose keys are worked out at once (8 bytes a key, in several arrays).
KEYED = 1 << 20
#: Keys that a task holds while it counts.
HELD_KEYS = 1 << 20
#: Words with this share of the tokens or more are sent to all tasks.
HEAD = 1 << 20
#: Word counts are handed on once a task holds so many words.
HELD_WORDS = 500_000
#: The end token's key among words, which are never empty.
END_WORD = b""


def keys(text: bytes, before: bytes = b"", last: bool = True) -> np.ndarray:
    """Deepest key of each byte of a text, and of the end if ``last``; ``before`` are the bytes ahead of it."""
    raw = np.frombuffer((b" " * LONG + before)[-LONG:] + text, np.uint8).astype(np.int64)
    n = len(text) + last
    out = np.full(n, LONG, np.int64)
    for i in range(LONG):
        out = out << 8 | raw[i : i + n]
    out <<= SYMBOL_BITS
    out[: len(text)] |= raw[LONG:]
    out[len(text) :] |= END
    return out


def shallower(node: np.ndarray, depth: int) -> np.ndarray:
    """The nodes of the last ``depth`` bytes of contexts."""
    return depth << NODE_BITS | node & (1 << 8 * depth) - 1


def _keys_of(text: bytes, before: bytes = b"", last: bool = True) -> Iterator[np.ndarray]:
    """Keys of a text in windows of bounded size."""
    for i in range(0, max(1, len(text)), KEYED):
        yield keys(text[i : i + KEYED], (before + text[max(0, i - LONG) : i])[-LONG:], last and i + KEYED >= len(text))


def _distinct(texts: list[Piece]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Ranges of texts with their distinct keys, the number of each key among them, and the keys of each text; a long text comes in several windows."""
    for i, j in groups_of([t.text for t in texts], KEYED):
        if j - i == 1:
            windows = ([k] for k in _keys_of(*texts[i]))
        else:
            windows = iter([[k for t in texts[i:j] for k in _keys_of(*t)]])
        for parts in windows:
            coded = pa.array(np.concatenate(parts)).dictionary_encode()
            yield i, j, coded.dictionary.to_numpy(), coded.indices.to_numpy(), np.array(list(map(len, parts)), np.int64)


class Piece(NamedTuple):
    """A part of a text that ends at white space, the last bytes before it, and whether the text ends with it."""

    text: bytes
    before: bytes = b""
    last: bool = True


def _pieces(text: bytes) -> list[Piece]:
    parts, out, before = list(slices(text, TEXTS)), [], b""
    for i, part in enumerate(parts):
        out.append(Piece(part, before, i == len(parts) - 1))
        before = (before + part[-LONG:])[-LONG:]
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to counts: rows (word, key, n) of a word or of a deepest key."""
    words: Counter[bytes] = Counter()
    held, n_held = [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        got, values = list(words.keys()), list(words.values())
        for i in range(0, len(got), 1 << 16):
            k = got[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.binary()), pa.nulls(len(k), pa.int64()), pa.array(values[i : i + (1 << 16)], pa.int64())], names=["word", "key", "n"])
        words.clear()

    def merged() -> tuple[np.ndarray, np.ndarray]:
        coded = pa.array(np.concatenate([k for k, _ in held])).dictionary_encode()
        n = np.bincount(coded.indices.to_numpy(), np.concatenate([n for _, n in held]), len(coded.dictionary))
        return coded.dictionary.to_numpy(), n.astype(np.int64)

    def flush_keys() -> Iterator[pa.RecordBatch]:
        key, n = merged()
        for i in range(0, len(key), 1 << 16):
            part = key[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(part), pa.binary()), pa.array(part), pa.array(n[i : i + (1 << 16)])], names=["word", "key", "n"])

    for b in batches:
        texts = [t.lower() for t in text_bytes(b.column(0))]
        words[END_WORD] += len(texts)
        for t in texts:
            for part in slices(t):
                words.update(part.split())
            if len(words) > HELD_WORDS:
                yield from flush()
        for _, _, key, index, _ in _distinct([Piece(t) for t in texts]):
            held.append((key, np.bincount(index, minlength=len(key))))
            n_held += len(key)
            if n_held > HELD_KEYS:
                held[:] = [merged()]
                n_held = len(held[0][0])
                if n_held > HELD_KEYS // 2:
                    yield from flush_keys()
                    held.clear()
                    n_held = 0
    yield from flush()
    if held:
        yield from flush_keys()


def trie(counts: DataFrame) -> DataFrame:
    """Counts (key, n) of deepest keys to those of all depths: rows (node, symbol, n)."""
    node = F.shiftright("key", SYMBOL_BITS)
    path = [(node.bitwiseAND(F.lit((1 << 8 * d) - 1)) + F.lit(d << NODE_BITS)).alias("node") for d in range(LONG + 1)]
    symbol = F.col("key").bitwiseAND(F.lit((1 << SYMBOL_BITS) - 1)).cast("short")
    return counts.select(F.explode(F.array(*path)).alias("node"), symbol.alias("symbol"), "n").groupBy("node", "symbol").agg(F.sum("n").alias("n"))


def nodes(rows: DataFrame) -> DataFrame:
    """The trie's rows to its nodes: (node, symbols, scores, escape, shift, further), all log10.

    ``scores`` are the probabilities of the symbols seen at the node, and
    ``escape`` that of any other. After an escape, a symbol that the parent has
    seen has its score there plus ``shift`` (as the node's own symbols are
    excluded), and one that it hasn't seen escapes from it with ``further``. All
    that a node has seen its parent has seen as well.
    """
    depth = F.shiftright("node", NODE_BITS)
    shorter = F.expr(f"(1L << CAST(8 * (shiftright(node, {NODE_BITS}) - 1) AS INT)) - 1")
    parent = F.when(depth > 0, F.col("node").bitwiseAND(shorter) + F.expr(f"(shiftright(node, {NODE_BITS}) - 1) << {NODE_BITS}"))
    above = rows.select(F.col("node").alias("parent"), "symbol", F.col("n").alias("n_above"))
    met = rows.withColumn("parent", parent).join(above, ["parent", "symbol"], "left")
    own = met.groupBy("node", "parent").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"), F.sum("n_above").alias("excluded"), F.collect_list(F.struct("symbol", "n")).alias("seen"))
    up = rows.groupBy(F.col("node").alias("parent")).agg(F.sum("n").alias("n_up"), F.count(F.lit(1)).alias("kinds_up"))
    # where all symbols are seen, or left, no escape is needed
    needed = lambda kinds, of: F.when(F.col(of) == SYMBOLS, 0).otherwise(kinds)
    whole = F.col("n") + needed(F.col("kinds"), "kinds")
    whole_up = F.col("n_up") + needed(F.col("kinds_up"), "kinds_up")
    more = needed(F.col("kinds_up") - F.col("kinds"), "kinds_up")
    left = F.col("n_up") - F.col("excluded") + more
    # a share that is zero, or of nothing, is never asked for
    log = lambda a, b: F.coalesce(F.log10(F.try_divide(a, b)), F.lit(0.0)).cast("float")
    further = F.when(F.col("kinds_up") == F.col("kinds"), F.lit(0.0)).otherwise(log(more, left)).cast("float")
    return own.join(up, "parent", "left").select(
        "node", F.col("seen.symbol").alias("symbols"), F.transform("seen", lambda x: F.log10(x["n"] / whole).cast("float")).alias("scores"),
        log(needed(F.col("kinds"), "kinds"), whole).alias("escape"), log(whole_up, left).alias("shift"), further.alias("further"),
    )


CHUNK = pa.schema([("chunk", pa.int64()), ("row_ids", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("befores", pa.list_(pa.binary())), ("lasts", pa.list_(pa.bool_())), ("texts", pa.binary()), ("nodes", pa.list_(pa.int64()))])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, held_out, text) to chunks of texts (compressed), each with the nodes of its contexts.

    A text beyond ``TEXTS`` is cut at white space into chunks of its own.
    """
    chunk = row = task_id() << 33
    held, contexts, size = [], [], 0

    def close() -> pa.RecordBatch:
        packed = pa.compress(b"".join(p.text for *_, p in held), codec="zstd", asbytes=True)
        rows, ids, outs, pieces = zip(*held, strict=True)
        columns = {"row_ids": rows, "doc_ids": ids, "held_out": outs, "sizes": [len(p.text) for p in pieces], "befores": [p.before for p in pieces], "lasts": [p.last for p in pieces]}
        return pa.RecordBatch.from_pydict({"chunk": [chunk], **{k: [list(v)] for k, v in columns.items()}, "texts": [packed], "nodes": [_paths(_merged(contexts))]}, schema=CHUNK)

    for b in batches:
        texts = [[(row + i, d, h, p) for p in _pieces(t.lower())] for i, (d, h, t) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_bytes(b.column(2)), strict=True))]
        row += b.num_rows
        flat = [x for pieces in texts for x in pieces]
        for i, j in groups_of([p.text for *_, p in flat], KEYED):
            more = sum(len(p.text) for *_, p in flat[i:j])
            if held and size + more > TEXTS:
                yield close()
                chunk, held, contexts, size = chunk + 1, [], [], 0
            for _, _, key, _, _ in _distinct([p for *_, p in flat[i:j]]):
                contexts.append(np.unique(key >> SYMBOL_BITS))
                if len(contexts) > 16:
                    contexts = [_merged(contexts)]
            held += flat[i:j]
            size += more
    if held:
        yield close()


def _merged(contexts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(contexts))


def _paths(deepest: np.ndarray) -> np.ndarray:
    return np.concatenate([deepest, *(np.unique(shallower(deepest, d)) for d in range(LONG))])


class Model:
    """A chunk's nodes, opened for scoring."""

    def __init__(self, rows: pa.Array):
        node, order = rows.field(0).to_numpy(), np.argsort(rows.field(0).to_numpy())
        self.node = node[order]
        self.escape, self.shift, self.further = (rows.field(i).to_numpy()[order].astype(np.float64) for i in (3, 4, 5))
        sizes = np.diff(rows.field(1).offsets.to_numpy())
        key = np.repeat(node, sizes) << SYMBOL_BITS | rows.field(1).flatten().to_numpy().astype(np.int64)
        by_key = np.argsort(key)
        self.key, self.score = key[by_key], rows.field(2).flatten().to_numpy()[by_key].astype(np.float64)
        # the root is node 0; what it hasn't seen is equally likely
        root = int(np.searchsorted(self.key, SYMBOLS))
        self.unseen = -np.log10(max(1, SYMBOLS - root))

    def scores(self, key: np.ndarray) -> np.ndarray:
        """log10 probabilities of deepest keys: from the deepest node of each, up to the first that has seen its symbol."""
        out = np.zeros(len(key))
        if not len(self.node):
            return out + self.unseen
        open_, node, symbol = np.arange(len(key)), key >> SYMBOL_BITS, key & (1 << SYMBOL_BITS) - 1
        # the node that each has escaped from, or -1
        below = np.full(len(key), -1)
        for depth in range(LONG, -1, -1):
            here = shallower(node, depth)
            wanted = here << SYMBOL_BITS | symbol
            k = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            hit = self.key[k] == wanted
            out[open_[hit]] += self.score[k[hit]] + np.where(below[hit] < 0, 0.0, self.shift[below[hit]])
            open_, node, symbol, below, here = (x[~hit] for x in (open_, node, symbol, below, here))
            i = np.minimum(np.searchsorted(self.node, here), len(self.node) - 1)
            known = self.node[i] == here
            out[open_] += np.where(known, np.where(below < 0, self.escape[i], self.further[below]), 0.0)
            below = np.where(known, i, -1)
        out[open_] += self.unseen
        return out


SCORED = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("head_known", pa.int64()), ("head_score", pa.float64()), ("score", pa.float64()), ("tail", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))])


def _scorer(common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = common.value
        for b in batches:
            for r in range(b.num_rows):
                _, rows, ids, held, sizes, befores, lasts = (b.column(k)[r].as_py() for k in range(7))
                ends = np.cumsum(sizes)
                whole = memoryview(pa.decompress(b.column(7)[r].as_buffer(), int(ends[-1]), codec="zstd"))
                texts = [Piece(bytes(whole[e - n : e]), before, last) for e, n, before, last in zip(ends.tolist(), sizes, befores, lasts, strict=True)]
                found = b.column(8)[r].values
                model = Model(b.column(8).values.slice(0, 0) if found is None else found)
                for i, j in groups_of([t.text for t in texts], KEYED):
                    yield _score_group(rows[i:j], ids[i:j], held[i:j], texts[i:j], model, head)

    return run


def _score_group(rows: list, ids: list, held: list, texts: list[Piece], model: Model, head: dict) -> pa.RecordBatch:
    out = {k: [] for k in SCORED.names}
    out["row_id"], out["doc_id"], out["held_out"] = rows, ids, held
    scores = np.zeros(len(texts))
    for i, j, key, index, lengths in _distinct(texts):
        if j - i == 1:  # a window of one text, which may have no byte and no end
            scores[i] += model.scores(key)[index].sum()
        else:
            each = np.r_[model.scores(key)[index], 0.0]
            scores[i:j] = np.where(lengths > 0, np.add.reduceat(each, np.cumsum(lengths) - lengths), 0.0)
    out["score"] = scores
    get = head.get
    end = get(END_WORD)
    for text, _, last in texts:
        known, total, tail, n = 0, 0.0, Counter(), 0
        for part in slices(text):
            words = part.split()
            got = list(map(get, words))
            rare = [w for w, v in zip(words, got, strict=True) if v is None]
            n += len(words)
            known += len(words) - len(rare)
            total += math.fsum(v for v in got if v is not None)
            tail.update(rare)
        if last and end is None:
            tail[END_WORD] += 1
        out["n_tokens"].append(n + last)
        out["head_known"].append(known + (last and end is not None))
        out["head_score"].append(total + ((end or 0.0) if last else 0.0))
        out["tail"].append([{"word": w, "n": c} for w, c in tail.items()])
    return pa.RecordBatch.from_pydict(out, schema=SCORED)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Score every whole text of rows (doc_id, text) with models learned where ``held_out`` is false.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score (log10 probabilities). Null and empty texts are the end alone. With
    nothing to learn from, counts are zero and every symbol is equally likely.
    Equal rows score alike; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    counted = rows.filter(~F.col("held_out")).select("text").mapInArrow(_count, "word binary, key long, n long")
    counts = materialise(counted.groupBy("word", "key").agg(F.sum("n").alias("n")), "lm-counts")
    words = counts.filter(F.col("word").isNotNull()).select("word", "n")
    total, distinct = words.filter("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    common = F.col("n") * HEAD >= total
    head = {bytes(r[0]): math.log10(r[1] + 0.5) for r in words.filter(common & (F.col("n") > 0)).collect()}
    grown = materialise(trie(counts.filter(F.col("key").isNotNull())), "lm-trie")
    at_node = nodes(grown)
    chunks = rows.mapInArrow(_chunks, "chunk long, row_ids array<long>, doc_ids array<long>, held_out array<boolean>, sizes array<long>, befores array<binary>, lasts array<boolean>, texts binary, nodes array<long>")
    chunks = materialise(chunks, "lm-chunks")
    sent = chunks.select("chunk", F.explode("nodes").alias("node")).join(at_node, "node")
    # at most LONG + 1 times as many as a chunk has bytes
    sent = sent.groupBy("chunk").agg(F.collect_list(F.struct("node", "symbols", "scores", "escape", "shift", "further")).alias("found"))
    ready = chunks.drop("nodes").join(sent, "chunk", "left")
    scored = ready.mapInArrow(_scorer(spark.sparkContext.broadcast(head)), "row_id long, doc_id long, held_out boolean, n_tokens long, head_known long, head_score double, score double, tail array<struct<word: binary, n: long>>")
    scored = materialise(scored, "lm-scored")
    tail = scored.select("row_id", F.explode("tail").alias("t")).select("row_id", "t.word", F.col("t.n").alias("times"))
    rare = words.filter(~common & (F.col("n") > 0))
    met = tail.join(rare, "word", "left")
    times = F.col("times")
    by_row = met.groupBy("row_id").agg(F.sum(F.when(F.col("n").isNotNull(), times).otherwise(0)).alias("tail_known"), F.sum(times * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("tail_score"))
    # the pieces of a long text are added up
    once = scored.groupBy("row_id").agg(*[F.first(c).alias(c) for c in ("doc_id", "held_out")], *[F.sum(c).alias(c) for c in ("n_tokens", "head_known", "head_score", "score")])
    all_ = once.join(by_row, "row_id", "left")
    norm = math.log10(total + 0.5 * (distinct + 1))
    base = F.col("head_score") + F.coalesce("tail_score", F.lit(0.0)) - F.col("n_tokens") * norm
    return all_.select("doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
