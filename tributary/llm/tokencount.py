"""Token counts under a unigram model, by dynamic programming over a shared trie.

A pre-token's best split into vocabulary pieces maximises the sum of the
pieces' scores. Pre-tokens with a common beginning have the same forward
scores there, so distinct pre-tokens are put in a trie and each node's best
score and piece count are worked out once, level by level, from those of its
ancestors; a pre-token's count is read at its last node. A node also carries,
for each ancestor within the longest piece, the state of a second trie that
holds the vocabulary, so no substring is ever built or hashed.

The vocabulary is that of a public tokenizer file. The pieces' log-probabilities
are learned from all documents: how often each piece comes in the file's own
split of the corpus.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import KEPT as KEPT_BETWEEN
from tributary.llm.common import fresh_task, groups_of, slices, small_batches, text_bytes

#: Score of a character that no piece covers, below the worst piece.
UNKNOWN_PENALTY = 10.0
#: Distinct pre-tokens whose counts a worker keeps.
KEPT = 500_000
#: Distinct pre-tokens that a worker adds up before it hands them on.
HELD = 500_000
#: Characters of a pre-token that are split at once while scores are learned.
LONGEST_SPLIT = 4_096
#: The first character of a piece at the start of a word.
WORD_START = "▁"
_BYTE_PIECE = re.compile(r"<0x[0-9A-F]{2}>|<\w+>|</\w+>")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to pre-tokens and how often each comes, added up while they fit."""
    held: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return batch

    for b in batches:
        for text in text_bytes(b.column(0)):
            for part in slices(text):
                held.update(part.split())
            if len(held) > HELD:
                yield flush()
    yield flush()


def learned_scores(docs: DataFrame, path: str | None = None) -> dict[str, float]:
    """Log-probability of each piece of a SentencePiece file by its share of the pieces in rows with a text (add half; control and byte pieces left out).

    Pre-tokens are counted over all rows first, so each distinct one is split
    once; the driver gets a number for each piece of the vocabulary.
    """
    import sentencepiece

    path = path or default_path()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for b in batches:
            total = np.zeros(model.get_piece_size(), np.int64)
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                text = word.decode()
                for i in range(0, len(text), LONGEST_SPLIT):
                    np.add.at(total, model.encode(text[i : i + LONGEST_SPLIT]), n)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "n"])

    words = docs.select("text").mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = dict(map(tuple, words.mapInArrow(split, "piece long, n long").groupBy("piece").agg(F.sum("n")).collect()))
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(p, counts.get(i, 0)) for i in range(model.get_piece_size()) if not _BYTE_PIECE.fullmatch(p := model.id_to_piece(i))]
    norm = np.log(sum(n for _, n in pieces) + 0.5 * len(pieces))
    return {p: float(np.log(n + 0.5) - norm) for p, n in pieces}


class Unigram:
    def __init__(self, scores: dict[str, float]):
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, scores), default=1)
        edges: dict[tuple[int, int], int] = {}
        ends: dict[int, float] = {}
        for piece, score in scores.items():
            state = 0
            for ch in piece:
                state = edges.setdefault((state, ord(ch)), len(edges) + 1)
            ends[state] = score
        keys = np.array([s << 21 | c for s, c in edges], np.int64)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.array(list(edges.values()), np.int64)[order]
        self.score = np.full(len(edges) + 1, -np.inf)
        self.score[list(ends)] = list(ends.values())
        self.kept: dict[bytes, int] = {}

    def _step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Next vocabulary state, or -1."""
        if not len(self.keys):
            return np.full(len(state), -1)
        key = np.where(state >= 0, state << 21 | char, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (state >= 0), self.to[at], -1)

    def counts(self, words: list[str]) -> np.ndarray:
        """Pieces in the best split of each pre-token; ties go to fewer pieces."""
        n = len(words)
        terminal = np.zeros(n, np.int64)
        if not n:
            return terminal
        order = np.array(sorted(range(n), key=words.__getitem__))
        sizes = np.array([len(words[i]) for i in order])
        flat = np.frombuffer("".join(words[i] for i in order).encode("utf-32-le"), "<u4").astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        width = min(self.longest, int(sizes.max(initial=0)))
        # a node of the trie is a run of the sorted pre-tokens: node[w] is where w is on the level
        node = np.zeros(n, np.int64)
        best, pieces = [np.zeros(1)], [np.zeros(1, np.int64)]
        states = np.full((1, 0), -1)  # of a node: vocabulary state of the run from each ancestor, nearest first
        up: list[np.ndarray] = []
        for depth in range(1, int(sizes.max(initial=0)) + 1):
            live = np.flatnonzero(sizes >= depth)
            char = flat[starts[live] + depth - 1]
            parent = node[live]
            new = np.r_[True, (parent[1:] != parent[:-1]) | (char[1:] != char[:-1])]
            number = np.cumsum(new) - 1
            node[live] = number
            first = np.flatnonzero(new)
            above, char = parent[first], char[first]
            grown = np.concatenate([np.zeros((len(first), 1), np.int64), states[above]], axis=1)[:, :width]
            states = np.stack([self._step(grown[:, j], char) for j in range(grown.shape[1])], axis=1)
            top, least = np.full(len(first), -np.inf), np.zeros(len(first), np.int64)
            ancestor = above
            for j in range(states.shape[1]):
                # the piece that begins at the ancestor j + 1 levels up
                got = np.where(states[:, j] >= 0, self.score[states[:, j]], -np.inf)
                if j == 0:
                    got = np.where(np.isneginf(got), self.unknown, got)
                value, count = best[-1 - j][ancestor] + got, pieces[-1 - j][ancestor] + 1
                better = (value > top + 1e-9) | ((value > top - 1e-9) & (count < least))
                better &= ~np.isneginf(value)
                top, least = np.where(better, value, top), np.where(better, count, least)
                if j + 1 < states.shape[1]:
                    ancestor = up[-1 - j][ancestor]
            up.append(above)
            best.append(top)
            pieces.append(least)
            if len(best) > width:
                best.pop(0)
                pieces.pop(0)
                up.pop(0) if len(up) > width else None
            done = live[sizes[live] == depth]
            terminal[order[done]] = least[node[done]]
        return terminal

    def count_texts(self, texts: list[bytes]) -> tuple[list[int], list[int]]:
        """Pre-tokens and tokens of whole texts. Distinct pre-tokens are counted once a group and kept for the next."""
        if len(self.kept) > KEPT:
            self.kept = {}
        split = [[part.split() for part in slices(t)] for t in texts]
        fresh = list({w for parts in split for p in parts for w in p}.difference(self.kept))
        if fresh:
            got = self.counts([WORD_START + w.decode() for w in fresh])
            self.kept.update(zip(fresh, got.tolist(), strict=True))
        place = self.kept.__getitem__
        return [sum(map(len, parts)) for parts in split], [sum(sum(map(place, p)) for p in parts) for parts in split]


#: The model of the last count that this worker took part in.
_made: dict[str, Unigram] = {}
KEPT_BETWEEN["tokencount"] = _made


def count_tokens(docs: DataFrame, path: str | None = None, scores: dict[str, float] | None = None) -> DataFrame:
    """doc_id, n_pretokens and n_tokens of every whole text of rows (doc_id, text), under ``scores`` or those learned from the rows.

    Pre-tokens are words between ASCII white space, each with the word-start
    mark. Null and empty texts have none; equal rows count alike; an empty
    table gives no rows; columns besides those read are left out. Only distinct
    pre-tokens and their counts are shuffled.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(learned_scores(docs, path) if scores is None else scores)
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task("tokencount")
        if name not in _made:
            _made.clear()
            _made[name] = Unigram(shared.value)
        unigram = _made[name]
        for b in batches:
            texts = text_bytes(b.column(1))
            for i, j in groups_of(texts):
                words, tokens = unigram.count_texts(texts[i:j])
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_pretokens", "n_tokens"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("n_pretokens long, n_tokens long").fields]))
