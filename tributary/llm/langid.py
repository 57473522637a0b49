"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are the runs of 1 to 4 bytes inside its lower-cased words,
with the word's edges. Each is hashed to a row of an embedding table; the
text's vector is their mean, and a linear layer with softmax gives language
probabilities. Both are trained in numpy by stochastic gradient descent on a
bounded sample of labelled rows, and a second sample calibrates the scores'
temperature and two limits under which an answer is rejected: its score, and
how common its subwords are in the training texts, which tells texts of other
languages even where one language's score must be high, as with one or two.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import fresh_task, groups_of, small_batches, text_bytes

UNDETERMINED = "und"
BUCKETS = 1 << 16
DIMENSIONS = 16
#: Expected number of training rows of each language (four fifths, if fewer), and of other rows that calibrate the limits.
SAMPLE_PER_LANGUAGE = 800
CALIBRATED_PER_LANGUAGE = 4_000
#: Expected number of training rows of all languages, and of other rows that calibrate, where there are many languages.
SAMPLE = 20_000
CALIBRATED = 200_000
#: Languages that a model may have; more labels are an error.
MOST_LANGUAGES = 1_000
EPOCHS = 6
BATCH = 32
RATE = 0.5
#: Share of right answers on the calibration rows that each limit of rejection may cost.
MOST_REJECTED = 0.0005
#: Share that a subword without training texts counts with.
UNSEEN = 2.0**-20
ORDERS = (1, 2, 3, 4)
#: Bytes whose subwords are held at once.
WINDOW = 1 << 18

# White space, ASCII marks and digits all become the word edge.
_FOLD = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)
_MULTIPLY = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def _hashes(folded: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Bucket of the run of ``order`` bytes at each place; 0 where it holds no letter or crosses a word's edge."""
    n = len(folded) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, order * 0x01000193, np.uint32)
    letter = folded != 32
    for i in range(order):
        h = (h ^ folded[i : i + n]) * np.uint32(_MULTIPLY[i])
    h ^= h >> np.uint32(15)
    inside = letter[:n].copy() if order == 1 else letter[:n] | letter[order - 1 : order - 1 + n]
    for i in range(1, order - 1):
        inside &= letter[i : i + n]
    return np.where(inside, 1 + h % np.uint32(buckets - 1), 0).astype(np.int64)


def subwords(text: bytes, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Buckets of a text's subwords, whole text, in bounded pieces."""
    raw = np.frombuffer(b" " + text + b" ", np.uint8)
    for i in range(0, len(raw), WINDOW):
        # pieces overlap by what the longest run needs; each run starts in one piece
        for order in ORDERS:
            piece = _FOLD[raw[i : i + WINDOW + order - 1]]
            got = _hashes(piece, order, buckets)
            yield got[got > 0]


def histogram(text: bytes, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of its subwords in each."""
    counts = np.zeros(buckets, np.int64)
    for got in subwords(text, buckets):
        counts += np.bincount(got, minlength=buckets)
    at = np.flatnonzero(counts)
    return at.astype(np.int32), (counts[at] / max(1, counts.sum())).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    #: What a subword adds to each language's logit: embedding times output layer.
    table: np.ndarray
    bias: np.ndarray
    #: Of each subword, log2 of its share in the training texts.
    known: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    least_known: float = float("-inf")

    def logits(self, texts: list[bytes]) -> np.ndarray:
        return self.means(texts)[:, :-1] + self.bias

    def means(self, texts: list[bytes]) -> np.ndarray:
        """Means of the table and of ``known`` over each text's subwords; texts are joined so that short ones share the work."""
        table = np.c_[self.table, self.known]
        out = np.zeros((len(texts), table.shape[1]))
        for i, j in groups_of(texts, WINDOW):
            if j - i == 1 and len(texts[i]) > WINDOW:
                total, n = np.zeros(table.shape[1]), 0
                for got in subwords(texts[i], len(table)):
                    total += table[got].sum(axis=0, dtype=np.float64)
                    n += len(got)
                out[i] = total / max(1, n)
                continue
            sizes = np.array([len(t) + 2 for t in texts[i:j]])
            ends = np.cumsum(sizes)
            folded = _FOLD[np.frombuffer(b" " + b"  ".join(texts[i:j]) + b" ", np.uint8)]
            total, n = np.zeros((j - i, table.shape[1])), np.zeros(j - i)
            for order in ORDERS:  # two edges between texts: no run holds letters of both
                got = _hashes(folded, order, len(table))
                starts = np.minimum(ends - sizes, max(0, len(got) - 1))
                if not len(got):
                    continue
                total += np.add.reduceat(table[got], starts, axis=0, dtype=np.float64)
                n += np.add.reduceat((got > 0).astype(np.int64), starts)
            out[i:j] = total / np.maximum(n, 1)[:, None]
        return out

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        x = logits / self.temperature
        e = np.exp(x - x.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: list[str], seed: int = 7) -> Model:
    """Train on histograms (buckets, shares, language place)."""
    rng = np.random.default_rng(seed)
    k, train = len(languages), np.arange(len(rows))
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    embed[0] = 0
    out, bias = np.zeros((DIMENSIONS, k), np.float32), np.zeros(k, np.float32)
    for epoch in range(EPOCHS):
        rate = np.float32(RATE * (1 - epoch / EPOCHS))
        shuffled = rng.permutation(train)
        for i in range(0, len(shuffled), BATCH):
            batch = shuffled[i : i + BATCH]
            at = np.concatenate([rows[r][0] for r in batch])
            share = np.concatenate([rows[r][1] for r in batch])[:, None]
            sizes = np.array([len(rows[r][0]) for r in batch])
            some = sizes > 0
            if not some.any():
                continue
            owner = np.repeat(np.arange(len(batch)), sizes)
            hidden = np.zeros((len(batch), DIMENSIONS), np.float32)
            starts = (np.cumsum(sizes) - sizes)[some]
            hidden[some] = np.add.reduceat(embed[at] * share, starts, axis=0)
            x = hidden @ out + bias
            p = np.exp(x - x.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), [rows[r][2] for r in batch]] -= 1
            back = p @ out.T
            out -= rate * (hidden.T @ p)
            bias -= rate * p.mean(axis=0)
            # mean pooling spreads a step thinly over many rows: embeddings take a larger one
            np.add.at(embed, at, -rate * 4 * share * back[owner])
    embed[0] = 0
    seen = np.zeros(BUCKETS)
    for i in train:
        seen[rows[i][0]] += rows[i][1]
    known = np.log2(seen / max(1.0, seen.sum()) + UNSEEN).astype(np.float32)
    known[0] = 0
    return Model(languages, embed @ out, bias, known)


def calibrate(model: Model, logits: np.ndarray, known: np.ndarray, truth: np.ndarray) -> None:
    """Choose the temperature of least loss, wrong answers included, and the limits that reject few right answers.

    The limits are the ``MOST_REJECTED`` quantiles of the right answers' scores
    and of how common their subwords are, each moved out by its standard error,
    so that a small calibration set rejects less rather than more.
    """
    if not len(truth):
        return
    losses = []
    for t in (grid := np.geomspace(0.002, 20, 120)):
        model.temperature = float(t)
        p = model.probabilities(logits)
        losses.append(-np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean())
    model.temperature = float(grid[int(np.argmin(losses))])
    p = model.probabilities(logits)
    right = p.argmax(axis=1) == truth
    if right.any():
        # rounding differs between ways to sum
        model.threshold = _limit(p.max(axis=1)[right]) - 1e-6
        with_words = right & (known < 0)
        model.least_known = _limit(known[with_words]) - 1e-3 if with_words.any() else float("-inf")


def _limit(values: np.ndarray) -> float:
    """The ``MOST_REJECTED`` quantile, less a deviation of the number of values under it."""
    expected = MOST_REJECTED * len(values)
    return float(np.sort(values)[max(0, int(expected - np.sqrt(expected)))])


def train(docs: DataFrame, use: Column, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Fit on rows (doc_id, text, lang) where ``use`` holds and lang is not null; None without any.

    The training sample is every row whose hash, of id and text, falls under the
    language's share, so it is the same on each run; rows that follow in that
    order calibrate. Equal rows count once. Histograms are made from whole texts
    by the executors; the driver gets about ``sample_per_language`` of them a
    language (``SAMPLE`` in all), and a few numbers of each calibration row.
    """
    small_batches(docs.sparkSession)
    usable = docs.filter(use & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = usable.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if not counts:
        return None
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    sizes = {r["lang"]: r["count"] for r in counts}
    languages = sorted(sizes)
    trained, calibrated = min(sample_per_language, SAMPLE / len(languages)), min(CALIBRATED_PER_LANGUAGE, CALIBRATED / len(languages))
    share = {k: min(0.8, trained / sizes[k]) if sizes[k] > 4 else 1.0 for k in languages}
    by_language = lambda f: F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(float(f(k))))])[F.col("lang")]
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    place = {k: i for i, k in enumerate(languages)}
    drawn = usable.select("lang", F.lower("text").alias("text"), draw.alias("draw")).withColumn("share", by_language(share.get))

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        for b in batches:
            made = [histogram(t) for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x, _ in made], pa.binary()), pa.array([y.tobytes() for _, y in made], pa.binary())], names=["lang", "at", "share"])

    few = drawn.filter(F.col("draw") < F.col("share")).dropDuplicates(["lang", "draw"]).select("lang", "text")
    made = few.mapInArrow(histograms, "lang string, at binary, share binary").toArrow().to_pylist()
    rows = sorted((r["lang"], r["at"], r["share"]) for r in made)
    model = fit([(np.frombuffer(a, np.int32), np.frombuffer(s, np.float32), place[k]) for k, a, s in rows], languages)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        for b in batches:
            got = shared.value.means(text_bytes(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in got], pa.binary())], names=["lang", "means"])

    rest = drawn.filter((F.col("draw") >= F.col("share")) & (F.col("draw") < F.col("share") + by_language(lambda k: calibrated / sizes[k]))).dropDuplicates(["lang", "draw"])
    # without rows to spare, those of the training calibrate
    for rows_ in (rest.select("lang", "text"), few):
        got = rows_.mapInArrow(means, "lang string, means binary").toArrow().to_pylist()
        if got:
            break
    told = np.array([np.frombuffer(r["means"]) for r in got]).reshape(-1, len(languages) + 1)
    calibrate(model, told[:, :-1] + model.bias, told[:, -1], np.array([place[r["lang"]] for r in got], np.int64))
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Append a struct ``language`` (lang_pred, score, rejected) to rows with a text column.

    Only the text is read. Null texts and texts without a letter are ``und``
    with score 0 and are rejected, as is all without a model; other answers are
    learned languages, and are rejected under either calibrated limit. Other
    columns, whatever their names, are kept untouched; equal rows answer alike.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.struct("*").alias("row"), F.when(F.col("text").rlike(r"\p{L}"), F.lower("text")).alias("text"))
    shared = spark.sparkContext.broadcast(model)
    names = ["lang_pred", "score", "rejected"]

    def answer(texts: pa.Array) -> list[pa.Array]:
        m, n = shared.value, len(texts)
        pred, score, rejected = [UNDETERMINED] * n, np.zeros(n), np.ones(n, bool)
        some = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False)) if m else []
        if len(some):
            means = m.means(text_bytes(texts.take(pa.array(some))))
            p = m.probabilities(means[:, :-1] + m.bias)
            best = p.argmax(axis=1)
            score[some] = p.max(axis=1)
            rejected[some] = (score[some] < m.threshold) | (means[:, -1] < m.least_known)
            for i, b in zip(some.tolist(), best.tolist(), strict=True):
                pred[i] = m.languages[b]
        return [pa.array(pred), pa.array(score), pa.array(rejected)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        for b in batches:
            language = pa.StructArray.from_arrays(answer(b.column(1)), names=names)
            yield pa.RecordBatch.from_arrays([b.column(0), language], names=["row", "language"])

    answered = T.StructType.fromDDL("language struct<lang_pred: string, score: double, rejected: boolean>")
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], answered["language"]]))
